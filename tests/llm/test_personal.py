"""Personal data against plain regular expressions and a plain version of the graph scores."""

import hashlib
import math
import random
import re

import pytest

from conftest import SMALL
from pairloom.llm import personal, queries

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = list(PLAIN)


def digits(value):
    return re.sub("[^0-9]", "", value)


def valid(kind, value):
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        d = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits(value)))]
        return 12 <= len(d) <= 19 and sum(x - 9 if x > 9 else x for x in d) % 10 == 0
    return 9 <= len(digits(value)) <= 15 if kind == "phone" else True


def plain_seeds(text):
    return sorted(
        (m.start(), rank, m.end(), kind)
        for rank, kind in enumerate(KINDS)
        for m in re.finditer(PLAIN[kind], text or "")
        if valid(kind, m[0])
    )


def plain_finds(texts, rounds=3, support=3, confidence=0.6):
    """Spans beyond the seeds per text; scores in units of a millionth, as the operator keeps them."""
    unit, met = 1_000_000, []
    for row, text in enumerate(texts):
        places = [m.span() for m in re.finditer(r"(?<!\S)[^\s0-9@]*[0-9@]\S*(?: (?=[0-9(])[0-9().-]+(?!\S))*", text or "", re.ASCII)]
        for i, (start, end) in enumerate(places):
            before = text[places[i - 1][1] if i else 0 : start][-40:].lower()
            after = text[end : places[i + 1][0] if i + 1 < len(places) else len(text)][:40].lower()
            value = text[start:end]
            inner = value.lstrip(personal.OPENING)
            start += len(value) - len(inner)
            value = inner.rstrip(personal.CLOSING)
            words, right = re.findall(r"[^\W\d_]+", before), re.findall(r"[^\W\d_]+", after)[:1]
            label = next((k for k in ("email", "ip", "phone", "card") if any(valid(k, m[0]) for m in re.finditer(PLAIN[k], value))), None)
            patterns = [f"{words[-2]} {words[-1]} *"] if len(words) > 1 else []
            patterns += [f"{words[-1]} * {r}" for r in right if words]
            met += [(row, start, start + len(value), value, label, p) for p in patterns if value]

    def possible(kind, value):
        low, high = personal.DIGITS.get(kind, (0, 10**9))
        return re.search(personal.POSSIBLE[kind], value, re.ASCII) is not None and low <= len(digits(value)) <= high

    edges = {(p, v): label for _, _, _, v, label, p in met}
    by_pattern = {}
    for p, v in edges:
        by_pattern.setdefault(p, []).append(v)
    by_pattern = {p: vs for p, vs in by_pattern.items() if len(vs) >= support and any(edges[p, v] for v in vs)}
    labels = {v: label for (_, v), label in edges.items()}
    score = {(v, k): unit * (labels[v] == k) for v in labels for k in KINDS}
    for turn in range(rounds):
        conf = {
            (p, k): sum(score[v, k] for v in vs) // (len(vs) + 1) if sum(score[v, k] * 2 >= unit for v in vs) >= support else 0
            for p, vs in by_pattern.items()
            for k in KINDS
        }
        if turn < rounds - 1:
            left = dict.fromkeys(score, 0)
            for p, vs in by_pattern.items():
                for v in vs:
                    for k in KINDS:
                        left[v, k] += round(-math.log(1 - min(conf[p, k], unit - 1) / unit) * unit)
            for v, k in score:
                score[v, k] = unit * (labels[v] == k) if labels[v] else round((1 - math.exp(-left[v, k] / unit)) * unit) * possible(k, v)
    found = {}
    for row, start, end, value, label, p in met:
        for rank, k in enumerate(KINDS):
            if label is None and conf.get((p, k), 0) >= confidence * unit and possible(k, value):
                found.setdefault((row, start, end), []).append((-conf[p, k], rank, k))
    out = [[] for _ in texts]
    for (row, start, end), kinds in found.items():
        _, rank, kind = min(kinds)
        if not any(s[0] < end and s[2] > start for s in plain_seeds(texts[row])):
            out[row].append((start, rank, end, kind))
    return out


def spans_of(rows, column):
    return [sorted(tuple(s) for s in r[column]) for r in rows]


def ordered(spark, texts, **options):
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, seeds string")
    return sorted(personal.find_private(frame, **options).collect(), key=lambda r: r["doc_id"])


def shown(spans):
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)


@pytest.mark.parametrize("folder", [SMALL, SMALL.replace("0.001", "0.01")])
def test_query_equals_plain_version(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    rows = {r["doc_id"]: r for r in queries.op11_bootstrapped_private(spark, folder).collect()}
    finds = plain_finds([d["text"] for d in docs])
    assert len(rows) == len(docs)
    for doc, more in zip(docs, finds):
        base, row = plain_seeds(doc["text"]), rows[doc["doc_id"]]
        assert row["base_sha256"] == hashlib.sha256(shown(base).encode()).hexdigest()
        assert row["spans"] == shown(sorted(base + more))
        assert [row[f"n_{k}"] for k in KINDS] == [sum(s[3] == k for s in base) for k in KINDS]


ODD = [
    "a@b.c_d@e.f g@h i@j@k.lm", "1.2.3.4.5.6.7.8 999.1.1.1 0255.000.1.2 1.2.3", "4111 1111-1111 1111 4111111111111112 4111  1111",
    "+1 (017) 555-7713 +49 30 1234567. +1234567890123456 +1 2", "é€\U0001f600 x.y@z.de \U0001f600+1 017 555 77 13é", None, "", " ", "@", "+", "-@-.-", "0",
    "mail:me@site.org,4111-1111-1111-1111;10.0.0.1", "9" * 5000, "9 " * 4000, "a" * 20000 + "@b.cd", "a." * 3000 + "@x", "1." * 3000, "+1" * 500, ("u%d@h.org " * 300) % tuple(range(300)),
]


def test_odd_texts(spark):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("ab1259.@-+ (%_)\n4") for _ in range(rng.randrange(80))) for _ in range(400)]
    rows = ordered(spark, texts)
    assert spans_of(rows, "seeds") == [plain_seeds(t) for t in texts]
    assert spans_of(rows, "spans") == [sorted(plain_seeds(t) + m) for t, m in zip(texts, plain_finds(texts))]


def test_unseen_forms_are_discovered(spark):
    """A local number behind "call me at", and a second pattern learnt through it in a later round."""
    texts = [f"You can call me at +1 555 010 {1000 + i} tomorrow." for i in range(6)]
    texts += [f"You can call me at 030-7654{100 + i} soon." for i in range(2)]
    texts += [f"Please dial 030-7654{100 + i} again." for i in range(2)] + [f"Please dial +1 555 020 {2000 + i} again." for i in range(4)]
    texts += ["Please dial 0171-888999 again.", "Item 5551234567 costs 4", "call me at 7pm"]
    rows = ordered(spark, texts)
    finds = plain_finds(texts)
    assert spans_of(rows, "spans") == [sorted(plain_seeds(t) + m) for t, m in zip(texts, finds)]
    new = [t[s[0] : s[2]] for t, m in zip(texts, finds) for s in m]
    assert "030-7654100" in new and "0171-888999" in new and len(new) == 5


def test_copies_do_not_make_a_pattern(spark):
    """One value in a thousand copies is one instance; three different ones are enough."""
    same = ["write to a@b.example now"] * 300 + ["write to root@localhost now"]
    assert not any(len(s) > 1 or s and s[0][3] != "email" or s == [(9, 0, 23, "email")] for s in spans_of(ordered(spark, same)[300:], "spans"))
    more = [f"write to u{i}@b.example now" for i in range(5)] + ["write to root@localhost now"]
    assert spans_of(ordered(spark, more), "spans")[-1] == [(9, 0, 23, "email")]


def test_no_rows_no_seeds_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert personal.find_private(empty).count() == 0
    assert spans_of(ordered(spark, ["room 12", None]), "spans") == [[], []]
    twice = spark.createDataFrame([(None, "x@y.de"), (None, "x@y.de"), (1, "x@y.de"), (1, "b")], "doc_id long, text string")
    assert sorted(len(r["spans"]) for r in personal.find_private(twice).collect()) == [0, 1, 1, 1]


def test_no_python_in_the_plan(spark):
    plan = queries.op11_bootstrapped_private(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
