"""Personal data: strict spans against plain scans, labelers' reliabilities, odd inputs."""

import hashlib
import re

from corpusloom.llm import personal_data as personal
from corpusloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
TEXTS = [
    "a@b.co, 1.2.3.4 x 256.1.1.1 4111 1111 1111 1111 and +1 (017) 555-7713. é (212) 555-1234 tel",
    "1.2.3.4.5.6.7.8 a@b.co_x@y.z 日本 4111111111111111 a@b.c.d..e",
    " ".join(f"x{i}@y.com" for i in range(300)),
    "call (212) 555-1234; john(at)mail.com",
    "x" * 20_000 + "@y.com " + "1" * 20_000,
    "+1 2 +", "", "@", None,
]


def luhn(digits):
    total = sum(x // 10 + x % 10 for x in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))))
    return total % 10 == 0


def strict(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    tests = {
        "email": lambda m: True,
        "ip": lambda m: all(int(p) <= 255 for p in m[0].split(".")),
        "card": lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m)),
        "phone": lambda m: 10 <= len(digits(m)) <= 15,
    }
    found = []
    for i, kind in enumerate(personal.KINDS):
        found += [(m.start(), i, kind, m.end()) for m in re.finditer(personal.STRICT[kind], text) if tests[kind](m)]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def check(rows, texts):
    for r in rows:
        want = strict(texts[r.doc_id] or "")
        listed = [f"{k}:{s}:{e}" for k, s, e in want]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, *_ in want) for x in personal.KINDS]
        spans = r.spans.split(",") if r.spans else []
        assert set(listed) <= set(spans) and len(spans) == len(listed) + r.n_added
        assert [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op4_personal_data"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    check(rows, texts)


def test_strict_spans(docs):
    rows = list(enumerate(TEXTS))
    check(personal.report(docs(rows)).collect(), dict(rows))


def test_main_path_has_no_python(docs):
    plan = personal.voted(personal.found(docs(list(enumerate(TEXTS)))))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_reliabilities_are_recovered():
    import random

    rng = random.Random(1)
    sharp, counts = (0.9, 0.85, 0.8, 0.75, 0.6), {}
    truth = {}
    for _ in range(20_000):
        true = rng.random() < 0.4
        votes = tuple((1 if true else -1) if rng.random() < p else (-1 if true else 1) for p in sharp)
        counts[votes] = counts.get(votes, 0) + 1
        truth[votes] = truth.get(votes, 0) + true
    belief = personal.reliabilities(sorted(counts.items()))
    off = sum(abs(belief[v] - truth[v] / n) * n for v, n in counts.items()) / 20_000
    assert off < 0.03


def test_odd_rows(odd, empty):
    rows = personal.report(odd).collect()
    assert len(rows) == 9 and all(r.spans == "" for r in rows)
    assert personal.report(empty).collect() == []
