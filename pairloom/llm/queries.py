"""One query per operator over the whole of its table, and SQL that gives the same rows where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import conversations, findings, language, maxscore, mixing, neighbours, packing, personal, quality, simhash, spelling, tokens, warc

Query = Callable[[SparkSession, str], DataFrame]

LIMIT = 512
SHARE = 0.6
EPOCHS = 4
#: Identifiers the vocabulary adds to its ranks.
SPECIAL = (("<|endoftext|>", 50256),)


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_prefix_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document, and the characters of its longest prefix within the limit."""
    docs = table(spark, folder, "documents")
    found = tokens.prefix_table(docs, vocabulary("byte_bpe_50k.json"), budgets=(LIMIT,), keep_steps=False)
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), F.col(f"fit_{LIMIT}").alias("fit_chars"))


def op2_weak_label_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document and whether it is kept."""
    docs = table(spark, folder, "documents")
    found = quality.score(docs, quality.fit(docs))
    return found.withColumn("keep", F.col("quality_score") >= quality.THRESHOLD)


def domain() -> Column:
    """The sources' domain in the sample tables: by their number."""
    number = F.regexp_extract(F.coalesce("source", F.lit("")), "([0-9]+)$", 1)
    return F.when(number == "", "other").otherwise(F.concat(F.lit("d"), (F.substring(number, -1, 1).cast("int") % 4).cast("string")))


def mixture() -> dict[str, Column]:
    return {
        "domain": F.when(F.col("domain") == "d0", 4.0).when(F.col("domain") == "d1", 3.0).when(F.col("domain") == "d2", 2.0).otherwise(1.0),
        "lang": F.when(F.col("lang") == "en", 3.0).otherwise(1.0),
        "source": F.when(F.col("source") == "src0", 2.0).otherwise(1.0),
    }


def op3_budget_tree(spark: SparkSession, folder: str) -> DataFrame:
    """What a mixture of a given share of all words takes of every document."""
    return mixing.mix(table(spark, folder, "documents"), SHARE, mixture(), domain(), EPOCHS)


def captures(pages: DataFrame) -> DataFrame:
    """Each page as a full response and, half a minute later under another spelling of its URL, a "not modified" answer.

    Of the answers some carry another entity tag, some only a time, some no validator but the digest.
    """
    tag, digest = F.concat(F.lit('"'), F.substring(F.md5("html"), 1, 16), F.lit('"')), F.md5("html")
    draw = F.pmod(F.conv(F.substring(F.md5(F.concat(F.lit("v"), F.col("page_id").cast("string"))), 1, 8), 16, 10).cast("long"), F.lit(8))
    time = F.concat(F.lit("t"), (F.col("page_id") * 60).cast("string"))

    def headers(**fields: Column) -> Column:
        flat = [x for name, value in fields.items() for x in (F.lit(name.replace("_", "-")), value)]
        return F.map_filter(F.create_map(*flat), lambda k, v: v.isNotNull())

    response = F.struct(
        F.concat(F.lit("a"), F.col("page_id").cast("string")).alias("record_id"), F.lit("response").alias("kind"), F.col("url"),
        (F.col("page_id") * 60).alias("date"), F.lit(200).alias("status"),
        headers(content_type=F.lit("text/html"), content_length=F.length("html").cast("string"), etag=F.when(draw != 6, tag),
                last_modified=time, cache_control=F.lit("max-age=60")).alias("headers"),
        digest.alias("digest"),
    )
    revisit = F.struct(
        F.concat(F.lit("b"), F.col("page_id").cast("string")).alias("record_id"), F.lit("revisit").alias("kind"),
        F.concat(F.regexp_replace("url", "#.*$", ""), F.lit("#again")).alias("url"),
        (F.col("page_id") * 60 + 30).alias("date"), F.lit(304).alias("status"),
        headers(etag=F.when(draw < 4, F.concat(F.lit("W/"), tag)).when(draw == 4, F.lit('"other"')), last_modified=F.when(draw.isin(4, 5, 6), time),
                cache_control=F.lit("no-cache"), content_length=F.lit("0")).alias("headers"),
        digest.alias("digest"),
    )
    return pages.select(F.explode(F.array(response, revisit)).alias("r")).select("r.*")


def shown(headers: Column) -> Column:
    pairs = F.array_sort(F.map_entries(headers))
    return F.array_join(F.transform(pairs, lambda p: F.concat(p["key"], F.lit(": "), p["value"])), "\n")


def op4_revisits(spark: SparkSession, folder: str) -> DataFrame:
    """The "not modified" answers among the captures of all pages, resolved."""
    found = warc.resolve_revisits(captures(table(spark, folder, "pages")))
    return found.withColumn("headers", shown(F.col("headers")))


def op5_multiprobe(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), 10, F.col("vec_id") % 100 == 0)


def op6_ppm_language(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every document; learnt without those held out."""
    docs = table(spark, folder, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    known = language.fit(docs.filter(~held_out))
    return language.predict(docs, known).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op7_maxscore(spark: SparkSession, folder: str) -> DataFrame:
    return maxscore.top_products(table(spark, folder, "embeddings"), 20, F.col("vec_id") % 20 == 0, 64)


def op8_histogram_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents and their places; the rank file is the fast form of the vocabulary of byte_bpe_50k.json."""
    return packing.pack_documents(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.tiktoken"), SPECIAL)


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_copies(table(spark, folder, "documents"), words=3, max_bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_secret_forest(spark: SparkSession, folder: str) -> DataFrame:
    """Every candidate in every document with the forest's judgement."""
    docs = table(spark, folder, "documents")
    return findings.scan(docs, findings.fit(docs))


def op11_bootstrapped_private(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document: counts and digest of the seeds, and all spans."""
    found = personal.find_private(table(spark, folder, "documents"))
    counts = [personal.count_of("seeds", k).alias(f"n_{k}") for k in personal.KINDS]
    return found.select("doc_id", *counts, F.sha2(personal.shown(F.col("seeds")), 256).alias("base_sha256"), personal.shown(F.col("spans")).alias("spans"))


def op12_spelling_machines(spark: SparkSession, folder: str) -> DataFrame:
    """Every frequent word of all documents with the word it is a variant of."""
    runs = spelling.mistyped_runs(table(spark, folder, "documents"))
    return spelling.variants(spelling.vocabulary(runs))


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults put in by the checksum of their conversation and number."""
    draw = F.crc32(F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    drawn = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), draw.alias("draw")).filter("draw <> 0")
    return drawn.select(
        "conv_id",
        "turn",
        F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(1), F.when(F.col("draw") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def op13_checkpointed_repair(spark: SparkSession, folder: str) -> DataFrame:
    """The cheapest repair of every damaged conversation."""
    turns = table(spark, folder, "conversations")
    return conversations.Repair(damaged(turns), turns).digests()


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_prefix_tokens, op2_weak_label_quality, op3_budget_tree, op4_revisits, op5_multiprobe, op6_ppm_language, op7_maxscore,
        op8_histogram_packing, op9_simhash, op10_secret_forest, op11_bootstrapped_private, op12_spelling_machines, op13_checkpointed_repair,
    )
}

#: SQL without a checksum function: a list of bytes, folded over the 256 steps of the polynomial.
CRC32 = """
    crc_steps AS (
        SELECT list(step ORDER BY i) AS steps FROM (
            SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS step
            FROM range(256) r(i)
        )
    )"""


def crc32_of(octets: str) -> str:
    fold = f"list_reduce(list_concat([4294967295::BIGINT], {octets}), lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))"
    return f"xor({fold}, 4294967295)"


def _repair_sql() -> str:
    """The repair as a recursion over rows from the last to the first.

    For each state the best ending is one string, twelve digits of cost and then its edits, so the least string is the
    cheapest and of equal ones the ASCII-least.
    """

    def then(value: str, cost: str, letter: str) -> str:
        return f"lpad(CAST(CAST({value}[1:12] AS BIGINT) + {cost} AS VARCHAR), 12, '0') || '{letter}' || {value}[13:]"

    following = (2, 2, 3, 2)
    kept = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
    rows = []
    for s in range(4):
        keep = "CASE " + " ".join(f"WHEN ini = '{i}' AND fault NOT IN (1, 2) THEN {then(f'v{t}', 'more', 'K')}" for i, t in kept[s].items()) + " END"
        rerole = f"CASE WHEN fault NOT IN (1, 2) THEN {then(f'v{following[s]}', '2 + more', 'R')} END"
        rows.append(f"least({then(f'v{s}', '3', 'D')}, {keep}, {rerole}) AS b{s}")
    inserted = [then(f"b{t}", "2", "I") for t in (2, 3)]
    return f"""
        WITH RECURSIVE {CRC32},
        keyed AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, list_transform(string_split(
                coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ord(c) AS BIGINT)) AS octets
            FROM conversations
        ),
        drawn AS (SELECT conv_id, turn, role, text, {crc32_of("octets")} % 20 AS d FROM keyed, crc_steps),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role, unnest(range(CASE WHEN d = 3 THEN 2 ELSE 1 END)) AS copy,
                CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM drawn WHERE d <> 0
        ),
        placed AS (
            SELECT conv_id, turn, role, text, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n, substr(role, 1, 1) AS ini,
                regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS solid
            FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)
        ),
        faulty AS (
            SELECT *, CASE WHEN solid = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
                WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
                lag(ini) OVER (PARTITION BY conv_id ORDER BY i) AS ini_before
            FROM placed
        ),
        ends AS (
            SELECT DISTINCT conv_id, n AS i, '000000000000' AS v0, '000000000004II' AS v1, '000000000002I' AS v2, '000000000000' AS v3 FROM faulty
            UNION ALL
            SELECT conv_id, i, least(b0, {then("u2", "2", "I")}), least(b1, {then("u2", "2", "I")}), u2, least(b3, {inserted[0]})
            FROM (
                SELECT *, least(b2, {inserted[1]}) AS u2 FROM (
                    SELECT e.conv_id, e.i - 1 AS i, CASE WHEN fault = 3 THEN 1 ELSE 0 END AS more, {", ".join(rows)}
                    FROM ends e JOIN faulty f ON e.conv_id IS NOT DISTINCT FROM f.conv_id AND e.i = f.i
                )
            )
        ),
        audits AS (SELECT conv_id, CAST(v0[1:12] AS BIGINT) AS cost, v0[13:] AS audit FROM ends WHERE i = 0),
        letters AS (
            SELECT conv_id, j, letter, count(*) FILTER (letter <> 'I') OVER w AS i, count(*) FILTER (letter <> 'D') OVER w AS k
            FROM (SELECT conv_id, unnest(range(1, length(audit) + 1)) AS j, unnest(string_split(audit, '')) AS letter FROM audits WHERE audit <> '')
            WINDOW w AS (PARTITION BY conv_id ORDER BY j)
        ),
        lines AS (
            SELECT l.conv_id, j, k, letter, role, text, max(CASE WHEN k = 1 AND letter = 'K' AND ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS led
            FROM letters l LEFT JOIN faulty f ON letter <> 'I' AND l.conv_id IS NOT DISTINCT FROM f.conv_id AND l.i = f.i
            WHERE letter <> 'D'
        ),
        repaired AS (
            SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (k - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
                CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS whole
            FROM lines GROUP BY conv_id
        ),
        sums AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
                count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
                count(*) FILTER (i > 1 AND ini_before || ini NOT IN ('su', 'ua', 'au')) AS illegal
            FROM faulty GROUP BY conv_id
        )
        SELECT c.conv_id, {", ".join(f"CAST(coalesce({x}, 0) AS BIGINT) AS {x}" for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))},
            coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c
        LEFT JOIN sums s ON c.conv_id IS NOT DISTINCT FROM s.conv_id
        LEFT JOIN audits a ON c.conv_id IS NOT DISTINCT FROM a.conv_id
        LEFT JOIN repaired r ON c.conv_id IS NOT DISTINCT FROM r.conv_id
    """


ORACLE: dict[str, str] = {
    "op13_checkpointed_repair": _repair_sql(),
    "op12_spelling_machines": f"""
        WITH RECURSIVE {CRC32},
        runs AS (
            SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\u00C0-\u00FF]+')) AS run
            FROM documents
        ),
        per_doc AS (SELECT id, run, count(*) AS times FROM runs GROUP BY ALL),
        octets AS (
            SELECT run, times, flatten(list_transform(string_split(id || ':' || run, ''), lambda c: CASE WHEN ord(c) < 128
                THEN [ord(c)::BIGINT] ELSE [192::BIGINT + (ord(c) >> 6), 128::BIGINT + (ord(c) & 63)] END)) AS octets
            FROM per_doc
        ),
        drawn AS (SELECT run, times, {crc32_of("octets")} AS h FROM octets, crc_steps),
        words AS (
            SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
                ELSE run END AS word, times
            FROM drawn
        ),
        vocab AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM words WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
        shorter AS (SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS cut FROM vocab, range(1, 100000) r(p) WHERE p <= length(word)),
        pairs AS (
            SELECT a.word, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b ON a.cut = b.cut AND a.p = b.p AND a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM shorter a JOIN vocab b ON a.cut = b.word
            UNION SELECT b.word, a.word, a.n FROM shorter a JOIN vocab b ON a.cut = b.word
        ),
        best AS (SELECT word, count(*) AS n_near, max(near_n) AS most FROM pairs GROUP BY word),
        chosen AS (SELECT word, n_near, most, min(near) AS near FROM best JOIN pairs USING (word) WHERE near_n = most GROUP BY ALL),
        forms AS (
            SELECT v.word, CASE WHEN most >= 5 * n THEN near END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * n THEN most END AS form_n
            FROM vocab v LEFT JOIN chosen USING (word)
        ),
        roots AS (
            SELECT word, word AS root FROM forms WHERE form IS NULL
            UNION ALL SELECT f.word, r.root FROM forms f JOIN roots r ON f.form = r.word
        )
        SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
    """,
    "op7_maxscore": """
        WITH w AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS w FROM embeddings),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
            FROM w q JOIN w c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
        ) WHERE rank <= 20
    """,
}
