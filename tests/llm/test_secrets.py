from __future__ import annotations

import random
import re
import string
import time

from pyspark.sql import functions as F

from tests.llm.conftest import ODD
from tierlake.llm import secrets

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                    r"([A-Za-z0-9+/_.=-]+)", re.I | re.A)


def base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text)
              if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found)]


def _texts():
    rng = random.Random(4)
    parts = ["password", "Token", "api_key", "APIKEY", '"', "'", " ", ":", "=", "abcdefgh", "x1",
             "AKIA", "ABCD1234EFGH", "0123456789abcdef", "é😀", "\n", "secret", ".", "deadbeef"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(400)] + [
        "secret: token: abcdefghij", "passwd=12345678", "AKIA" * 8, "f" * 31, "f" * 32]


def test_base_spans_equal_brute_force(documents):
    texts = _texts()
    rows = secrets.base_spans(documents(texts)).select(
        "doc_id", secrets.listed(("assign", "access", "hex")).alias("spans")).collect()
    assert {r.doc_id: r.spans for r in rows} == {
        i: ",".join(base(t)) for i, t in enumerate(texts)}


def test_markov_tells_random_from_ordinary(spark, documents):
    rng = random.Random(6)
    keys = ["".join(rng.choice(string.ascii_letters + string.digits) for _ in range(40))
            for _ in range(60)]
    words = "alpha beta gamma delta network training connection value handler request".split()
    texts = [f"token = {k}" for k in keys[:40]] + [
        " ".join(rng.choice(words) for _ in range(80)) for _ in range(60)]
    texts += [f"see {k} here" for k in keys[40:]]
    names = ["training_connection_handler", "requestValueHandlerNetwork", "deltagammabetaalphabeta"]
    texts += [f"call {n} now" for n in names]
    docs = documents(texts)
    got = secrets.scan(docs, secrets.train(docs))
    found = {r.doc_id: r.markov for r in got.collect()}
    for i, key in enumerate(keys[40:], start=100):
        assert [(m.start, m.end, m.value) for m in found[i]] == [(4, 44, key)]
    assert not any(found[i] for i in [*range(100), *range(120, 123)])


def test_spans_apart_equal_all_pairs(spark):
    rng = random.Random(8)

    def spans(n):
        cuts = sorted(rng.sample(range(n * 9), 2 * n))
        return [(a, b, str(a)) for a, b in zip(cuts[::2], cuts[1::2])]

    kind = "array<struct<start:int,end:int,value:string>>"
    rows = [(i, spans(n), spans(m) + spans(k)) for i, (n, m, k) in enumerate(
        [(0, 0, 0), (1, 0, 0), (0, 1, 0), (5, 5, 0), (300, 40, 3), (256, 9, 7), (700, 600, 90)] * 3)]
    got = spark.createDataFrame(rows, f"i int, own {kind}, others {kind}").select(
        "i", secrets.apart(F.col("own"), F.col("others")).alias("left")).collect()
    assert {r.i: [tuple(s) for s in r.left] for r in got} == {
        i: [s for s in own if not any(o[0] < s[1] and s[0] < o[1] for o in others)]
        for i, own, others in rows}


def test_many_matches_in_a_text(spark, documents):
    """40,000 matches of one kind and 10,000 candidates take seconds, not minutes."""
    rng = random.Random(9)
    text = " ".join(f"token={rng.randrange(10**8, 10**9)} x token={rng.randrange(10**9)}z" + (
        f" {'Ab1' * 8}" if i % 2 else "") for i in range(20_000))
    began = time.monotonic()
    docs = documents([text])
    row = secrets.scan(docs, [0.0] * (len(secrets.ALPHABET) + 1) ** 2, 0.0).withColumn(
        "base", secrets.listed(("assign", "access", "hex"))).first()
    assert row["base"] == ",".join(base(text))
    assert len(row.markov) == 10_000
    assert time.monotonic() - began < 60


def test_spans_are_native(spark, documents):
    docs = documents(["a"])
    plan = secrets.scan(docs, [0.0] * (len(secrets.ALPHABET) + 1) ** 2)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", text)


def test_odd_rows(documents):
    docs = documents(ODD)
    got = secrets.scan(docs, secrets.train(docs)).withColumn(
        "all", secrets.listed(secrets.KINDS)).collect()
    assert len(got) == len(ODD)
    assert all(r["all"] == "" for r in got if r.doc_id != 5), "one long word of one letter"
    assert secrets.scan(docs.limit(0), secrets.train(docs.limit(0))).count() == 0
    nulls = docs.withColumn("text", F.lit(None).cast("string"))
    assert secrets.scan(nulls, secrets.train(nulls)).filter(F.size("hex") > 0).count() == 0
