"""Secrets in texts: candidates by shape, false positives removed by a random forest.

A candidate is a long run of key characters, a value given to a secret's name,
what follows ``Bearer`` or a key block.  The forest looks at its length,
at how usual its character transitions are, how much of it words of the
dictionary cover, at the path of the text and at the neighbouring words.
Dictionary and transitions come from all texts.  The forest is trained from
bounded hash samples of the findings of all texts that rules label true and
false, and from made-up cases of every form, so that it knows those that a
table holds rarely or not at all.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import kind_of, map_batches
from pairloom.session import bounded_rows, drop_scratch, settle

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_BREAK = r"(?:\s|\\[nr])"
#: A key block: header fields, key lines without blanks (the first long), and the end mark if it is there.  A
#: header alone, as in prose about keys, is none, and a block without an end stops with its key lines.
BLOCK = re.compile(
    r"-----BEGIN [A-Z ]*PRIVATE KEY(?: BLOCK)?-----"
    rf"(?:{_BREAK}{{1,4}}[A-Za-z-]{{2,30}}:[ \t][^\r\n]{{0,200}}){{0,6}}"
    rf"{_BREAK}{{0,4}}[A-Za-z0-9+/]{{40,}}={{0,2}}(?:{_BREAK}{{1,4}}[A-Za-z0-9+/]{{16,}}={{0,2}})*"
    rf"(?:{_BREAK}{{1,4}}[A-Za-z0-9+/]{{1,15}}={{0,2}}(?={_BREAK}{{0,4}}-----END))?"
    rf"(?:{_BREAK}{{0,4}}-----END [A-Z ]*PRIVATE KEY(?: BLOCK)?-----)?"
)
BEARER = re.compile(r"\b(?:bearer|basic)[ \t]+([A-Za-z0-9+/_.~-]{12,}={0,2})", re.IGNORECASE)
ASSIGNED = re.compile(
    r"(?:key|token|secret|passw|pwd|auth|credential)\w{0,24}[\"'`]?[ \t]{0,8}(?:=>|:=|[:=])[ \t]{0,8}(?:\"([^\"\s]{6,})\"|'([^'\s]{6,})'|`([^`\s]{6,})`|([^\s\"'`,;<>()\[\]{}]{6,}))",
    re.IGNORECASE,
)
#: What keys of well-known providers look like.
KNOWN = re.compile(
    r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,}|github_pat_\w{22,}|sk-[A-Za-z0-9_-]{20,}|[sr]k_(?:live|test)_[A-Za-z0-9]{16,}"
    r"|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[\w-]{35}|glpat-[\w-]{20,}|npm_[A-Za-z0-9]{30,}|hf_[A-Za-z0-9]{30,}|eyJ[\w-]{8,}\.[\w-]{8,}(?:\.[\w-]*)?)"
)
NAMES = re.compile(r"key|token|secret|passw|pwd|auth|credential|bearer", re.IGNORECASE)
PATHS = re.compile(r"env|conf|cred|secret|key|\.pem|\.ya?ml|\.ini|\.json", re.IGNORECASE)
BEARER_BEFORE = re.compile(r"\b(?:bearer|basic)[ \t]+\Z", re.IGNORECASE)
WORD = re.compile(r"[A-Za-z]{3,}")
LETTERS = 26
HEX = re.compile(r"[0-9a-fA-F]+\Z")
#: Characters looked at before and after a candidate.
NEAR = 40
#: Labelled findings used of each class, made-up cases of each form, dictionary words kept.
FINDINGS = 10_000
MADE_UP = 150
DICTIONARY = 20_000
TREES, DEPTH, LEAF, CUTS = 25, 8, 3, 16
SEED = 3
THRESHOLD = 0.5
MARK = "[SECRET]"


@dataclass
class Language:
    """What usual text looks like: its words and the log shares of its character transitions."""

    words: frozenset[str]
    transitions: dict[str, float]

    def coverage(self, text: str) -> float:
        """Share of the characters that dictionary words cover, the longest first from the left."""
        low, at, covered = text.lower(), 0, 0
        while at < len(low):
            for size in range(min(12, len(low) - at), 2, -1):
                if low[at : at + size] in self.words:
                    covered, at = covered + size, at + size
                    break
            else:
                at += 1
        return covered / len(text)

    def usual(self, text: str) -> float:
        low = text.lower()
        return sum(self.transitions.get(low[i : i + 2], -12.0) for i in range(len(low) - 1)) / max(1, len(low) - 1)


def learn_language(words: Counter, most: int = DICTIONARY) -> Language:
    """From words with counts; ties in the dictionary go to the smaller word."""
    pairs: Counter = Counter()
    for word, n in words.items():
        for i in range(len(word) - 1):
            pairs[word[i : i + 2]] += n
    total = sum(pairs.values())
    kept = sorted((w for w, n in words.items() if n > 1), key=lambda w: (-words[w], w))[:most]
    return Language(frozenset(kept), {p: float(np.log(n / total)) for p, n in pairs.items()})


def spans(text: str | None) -> list[tuple[int, int]]:
    """Places of the candidates from the left; shapes that overlap make one candidate of all their characters."""
    if not text:
        return []
    shapes = (BLOCK, KNOWN, BEARER, ASSIGNED, CANDIDATE)
    found: list[tuple[int, int]] = []
    for start, end in sorted(m.span(m.lastindex or 0) for shape in shapes for m in shape.finditer(text)):
        if found and start < found[-1][1]:
            found[-1] = found[-1][0], max(end, found[-1][1])
        else:
            found.append((start, end))
    return found


def entropy(value: str) -> float:
    """Bits a character."""
    n = len(value)
    return -sum(c / n * np.log2(c / n) for c in Counter(value).values())


def features(text: str, start: int, end: int, path: str, language: Language) -> list[float]:
    value = text[start:end]
    before, after = text[max(0, start - NEAR) : start], text[end : end + NEAR]
    lead = before.rstrip(" \t\"'`")
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o" for c in value]
    n = len(value)
    return [
        n,
        kinds.count("d") / n,
        kinds.count("u") / n,
        kinds.count("o") / n,
        len(set(value)) / n,
        sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / n,
        language.usual(value),
        language.coverage(value),
        float(HEX.match(value) is not None),
        float(NAMES.search(lead[-24:]) is not None),
        float(lead.endswith(("=", ":"))),
        float(before.endswith(("\"", "'", "`")) and after.startswith(("\"", "'", "`"))),
        float(NAMES.search(after) is not None),
        sum(w.lower() in language.words for w in WORD.findall(before + " " + after)),
        float(PATHS.search(path) is not None),
        path.count("/"),
        entropy(value),
        float(KNOWN.fullmatch(value) is not None),
        float(value.startswith("-----BEGIN ")),
        float(BEARER_BEFORE.search(before) is not None),
    ]


def rule_label(row: list[float]) -> bool:
    """Stands in for an analyst: any one of several rules that do not need each other.

    A key block; a known provider's key; a header's value of mixed characters; a named and assigned value of mixed
    characters, quoted or not; a long value of mixed characters and high entropy that is named shortly before.
    """
    mixed = row[1] > 0 and row[7] < 0.6 and (row[4] >= 0.15 or row[16] >= 3.0)
    if row[18] or row[17] and row[1] > 0 and row[16] >= 2.5:
        return True
    if row[19] and mixed:
        return True
    if row[9] and row[10] and mixed and (row[16] >= 2.5 or row[11] == 1):
        return True
    return bool(row[9] and mixed and row[0] >= 20 and row[16] >= 3.2)


def made_up(language: Language, seed: int = SEED) -> list[tuple[list[float], bool]]:
    """Features of cases of every form, secret or not, that no text has to hold."""
    draw = np.random.default_rng([seed, 1])
    words = sorted(language.words)[:2000] or ["the", "value", "house", "other", "some", "text"]
    hexes, mixed, plain = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"

    def some(kind: str, low: int, high: int) -> str:
        return "".join(kind[i] for i in draw.integers(0, len(kind), draw.integers(low, high + 1)))

    def prose(n: int, by: str = " ") -> str:
        return by.join(words[i] for i in draw.integers(0, len(words), n))

    def pick(*of: str) -> str:
        return of[draw.integers(0, len(of))]

    forms = (
        (True, lambda: (pick("key", "token = ", "api_key: ", "password=").rstrip("=: ") + pick(" = ", "=", ": "), pick(some(hexes, 32, 64), some(mixed, 16, 48)), '"')),
        (True, lambda: (pick("API_KEY=", "SECRET_TOKEN=", "DB_PASSWORD=", "auth_token: ", "password: "), pick(some(mixed, 16, 48), some(hexes, 24, 64)), "")),
        (True, lambda: (pick("password = ", "passwd: ", "pwd=", "PASSWORD="), some(mixed + "!#$%&*?@", 7, 7) + some("0123456789", 1, 8), pick('"', "'", ""))),
        (True, lambda: (pick("Authorization: Bearer ", "authorization: Basic ", "bearer "), pick(some(mixed, 20, 60), some(hexes, 32, 64)) + some("0123456789", 1, 1), "")),
        (True, lambda: (prose(3) + " ", pick("AKIA" + some(plain, 16, 16), "ghp_" + some(mixed, 36, 36), "sk_live_" + some(mixed, 24, 24), "sk-" + some(mixed, 40, 48), "AIza" + some(mixed, 35, 35), "xoxb-" + some(mixed, 24, 40), "glpat-" + some(mixed, 20, 20)), "")),
        (True, lambda: (prose(3) + "\n", f"-----BEGIN {pick('', 'RSA ', 'EC ', 'OPENSSH ')}PRIVATE KEY-----\n{some(mixed, 64, 900)}\n-----END PRIVATE KEY-----", "")),
        (False, lambda: (prose(4) + " ", pick(some(hexes, 32, 64), some(hexes, 40, 40)), "")),
        (False, lambda: (prose(4) + pick(" ", " (", "/"), pick(prose(4, "-"), prose(3, "_"), prose(4, "/")) + "-more-words-here", "")),
        (False, lambda: (pick("key = ", "token: ", "password: ", "auth="), pick(prose(3, "_"), prose(2, "-"), "required", "changeme", "optional"), pick('"', ""))),
        (False, lambda: (prose(4) + " ", pick("x", "-", "_", "=a") * int(draw.integers(16, 60)), "")),
    )
    out = []
    for secret, form in forms:
        for _ in range(MADE_UP):
            lead, value, quote = form()
            text = f"{prose(6)} {lead}{quote}{value}{quote} {prose(6)}"
            start = text.index(lead + quote + value) + len(lead + quote)
            out.append((features(text, start, start + len(value), "", language), secret))
    return out


class Forest:
    """Binary trees as arrays; a tree votes with the share of secrets in the leaf."""

    def __init__(self, seed: int = SEED):
        self.seed = seed
        self.trees: list[tuple[np.ndarray, ...]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Forest:
        draw = np.random.default_rng(self.seed)
        some = max(1, round(x.shape[1] ** 0.5))
        for _ in range(TREES if len(x) else 0):
            rows = draw.integers(0, len(x), len(x))
            nodes: list[list[float]] = []
            self._grow(x[rows], y[rows].astype(float), draw, some, 0, nodes)
            self.trees.append(tuple(np.array(c) for c in zip(*nodes, strict=True)))
        return self

    def _grow(self, x: np.ndarray, y: np.ndarray, draw: np.random.Generator, some: int, depth: int, nodes: list) -> int:
        """Append the node (feature, border, low child, high child, share) and those below it."""
        own = len(nodes)
        nodes.append([-1, 0.0, 0, 0, float(y.mean())])
        if depth == DEPTH or len(y) < 2 * LEAF or y.min() == y.max():
            return own
        best = (y.var() * len(y) - 1e-9, -1, 0.0)
        for f in draw.permutation(x.shape[1])[:some]:
            for border in np.unique(np.quantile(x[:, f], np.linspace(0, 1, CUTS + 2)[1:-1], method="lower")):
                low = x[:, f] <= border
                n = int(low.sum())
                if LEAF <= n <= len(y) - LEAF:
                    left = y[low].var() * n + y[~low].var() * (len(y) - n)
                    if left < best[0]:
                        best = (left, f, border)
        if best[1] < 0:
            return own
        low = x[:, best[1]] <= best[2]
        nodes[own][:2] = best[1], best[2]
        nodes[own][2] = self._grow(x[low], y[low], draw, some, depth + 1, nodes)
        nodes[own][3] = self._grow(x[~low], y[~low], draw, some, depth + 1, nodes)
        return own

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for feature, border, low, high, share in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                f = feature[at].astype(np.int64)
                down = np.where(x[np.arange(len(x)), f] <= border[at], low[at], high[at]).astype(np.int64)
                at = np.where(f < 0, at, down)
            total += share[at]
        return total / max(1, len(self.trees))


@dataclass
class Detector:
    language: Language
    forest: Forest

    def find(self, text: str | None, path: str | None) -> list[tuple[int, int, float]]:
        """``(start, end, score)`` of every candidate."""
        found = spans(text)
        if not found:
            return []
        rows = np.array([features(text, a, b, path or "", self.language) for a, b in found])
        return [(a, b, float(s)) for (a, b), s in zip(found, self.forest.predict(rows), strict=True)]


def labelled(docs: DataFrame, language: Language, label: Callable[[list[float]], bool], most: int, seed: int) -> DataFrame:
    """``(secret, place, row)``: of each class and task the ``most`` findings of smallest hash; equal surroundings count once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bool, dict[int, list[float]]] = {False: {}, True: {}}
        for batch in batches:
            for text, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for start, end in spans(text):
                    near = text[max(0, start - NEAR) : end + NEAR]
                    place = xxhash.xxh64_intdigest(near.encode("utf-8"), seed) >> 1
                    row = features(text, start, end, path or "", language)
                    own = kept[bool(label(row))]
                    own[place] = row
                    if len(own) >= 2 * most:
                        for far in sorted(own)[most:]:
                            del own[far]
        for secret, own in kept.items():
            least = sorted(own)[:most]
            columns = [pa.array([secret] * len(least), pa.bool_()), pa.array(least, pa.int64()), pa.array([own[k] for k in least], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["secret", "place", "row"])

    return docs.mapInArrow(work, "secret boolean, place long, row array<double>")


def corpus_language(docs: DataFrame, text_column: str = "text", most: int = DICTIONARY) -> Language:
    """Transitions of all words of all texts, each word once a text; dictionary of the words that most texts hold.

    The dictionary has at most ``most`` words.  Words are sorted into steps of equal frequency (exact below 64, of about
    one percent above) and whole steps are taken, so the driver sees a row a step and the words taken.
    """

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            counts: Counter = Counter()
            for text in batch.column(0).to_pylist():
                counts.update({w.lower() for w in WORD.findall(text or "")})
            return {"word": list(counts), "n": list(counts.values())}

        return work

    counted = map_batches(docs.select(text_column), make, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    seen, path = settle(counted.withColumn("step", F.floor(F.log2("n") * 64)), "words")
    pair = F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring(F.col("word"), i, 2)))
    pairs = bounded_rows(seen.select(pair.alias("pair"), "n").groupBy("pair").agg(F.sum("n").alias("n")), LETTERS**2, "the transitions")
    steps = bounded_rows(seen.filter("n > 1").groupBy("step").agg(F.count(F.lit(1)).alias("words")), 64 * 64, "the steps")
    border, room = None, most
    for row in sorted(steps, key=lambda r: -r["step"]):
        room -= row["words"]
        if room < 0:
            break
        border = row["step"]
    words = [] if border is None else bounded_rows(seen.filter((F.col("n") > 1) & (F.col("step") >= border)).select("word"), most, "the dictionary")
    drop_scratch(docs.sparkSession, path)
    total = sum(r["n"] for r in pairs)
    return Language(frozenset(r["word"] for r in words), {r["pair"]: float(np.log(r["n"] / total)) for r in sorted(pairs)})


def fit(
    docs: DataFrame, label: Callable[[list[float]], bool] = rule_label, most: int = FINDINGS, seed: int = SEED,
    id_column: str = "doc_id", text_column: str = "text", path_column: str = "source",
) -> Detector:
    """Dictionary and transitions from all texts; forest from about ``most`` findings of each class among all, by hash.

    ``label`` tells the true findings.  Made-up cases (``made_up``) go with them, so neither class is ever empty.
    """

    language = corpus_language(docs, text_column)
    found, _ = settle(labelled(docs.select(text_column, path_column), language, label, most, seed), "findings")
    drawn, _ = settle(found.groupBy("secret", "place").agg(F.min("row").alias("row")), "drawn")
    cases = made_up(language, seed)
    for secret in (False, True):
        own = drawn.filter(F.col("secret") == secret)
        n = own.count()
        # the border is exact to a ten thousandth of the rows
        border = own.agg(F.percentile_approx("place", min(1.0, most / max(1, n)), 10_000)).first()[0]
        cases += [(r["row"], secret) for r in own.filter(F.col("place") <= F.lit(border)).collect()] if n else []
    cases.sort()
    return Detector(language, Forest(seed).fit(np.array([c[0] for c in cases]), np.array([c[1] for c in cases])))


def scan(docs: DataFrame, detector: Detector, id_column: str = "doc_id", text_column: str = "text", path_column: str = "source") -> DataFrame:
    """``(id, start, length, digest, score, is_secret)`` of every candidate of every row.

    ``start`` and ``length`` count characters; ``digest`` tells equal values apart from others without showing them.
    Null and empty texts have no candidates, null paths are empty, repeated rows have their candidates each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(detector)

    def make():
        known = shared.value

        def work(batch: pa.RecordBatch) -> dict:
            take, rows = [], []
            for k, (text, path) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                for start, end, score in known.find(text, path):
                    take.append(k)
                    digest = hashlib.sha256(text[start:end].encode("utf-8")).hexdigest()[:16]
                    rows.append((start, end - start, digest, score, score >= THRESHOLD))
            columns = list(map(list, zip(*rows, strict=True))) or [[]] * 5
            return {id_column: batch.column(0).take(pa.array(take, pa.int64()))} | dict(
                zip(("start", "length", "digest", "score", "is_secret"), columns, strict=True)
            )

        return work

    schema = f"`{id_column}` {kind_of(docs, id_column)}, start long, length long, digest string, score double, is_secret boolean"
    return map_batches(docs.select(id_column, text_column, path_column), make, schema)


def redact(docs: DataFrame, detector: Detector, text_column: str = "text", path_column: str = "source") -> DataFrame:
    """``docs`` with every secret in the text replaced by a mark; all rows and columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(detector)
    names = docs.columns
    text_at, path_at = names.index(text_column), names.index(path_column)

    def make():
        known = shared.value

        def one(text: str | None, path: str | None) -> str | None:
            parts, at = [], 0
            for start, end, score in known.find(text, path):
                if score >= THRESHOLD:
                    parts += [text[at:start], MARK]
                    at = end
            return "".join([*parts, text[at:]]) if parts else text

        def work(batch: pa.RecordBatch) -> dict:
            texts = [one(t, p) for t, p in zip(batch.column(text_at).to_pylist(), batch.column(path_at).to_pylist(), strict=True)]
            return {n: texts if k == text_at else batch.column(k) for k, n in enumerate(names)}

        return work

    return map_batches(docs, make, ", ".join(f"`{n}` {kind_of(docs, n)}" for n in names))
