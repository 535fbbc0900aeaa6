import hashlib
import random
import re

import messy
from pyspark.sql import functions as F

from gridledger.llm import personal

SHAPES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def holds(kind, s):
    digits = re.sub("[^0-9]", "", s)
    return {
        "email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in s.split(".")),
        "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
    }[kind]


def plain(text):
    out = []
    for k, (kind, shape) in enumerate(SHAPES.items()):
        out += [(m.start(), k, m.end()) for m in re.finditer(shape, text or "") if holds(kind, m[0])]
    return sorted(out)


def named(spans):
    return ",".join(f"{personal.KINDS[k]}:{a}:{b}" for a, k, b in spans)


HARD = [
    "a@b.co_x@y.zz", "a@b.c.d@e.f", "abc@def@x.y", "x@y", "@a.b", "é a.b+c%d@mail-1.example.com.", "🙂🙂 me@x.yz 🙂 1.2.3.4",
    "1.2.3", "1.2.3.4.5.6.7.8", "256.1.1.1 255.255.255.255", "0000001.2.3.4", "1.2.3.4x 01.002.0003.255", "9" * 300 + ".1.1.1",
    "4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1111 5500000000000004", "4111  111111111111", "411111111111111",
    "x4111111111111111y", "4111 1111 1111 1111 2", "12 34 4111111111111111", "1-4111111111111111", "0" * 12, "0" * 19, "0" * 20,
    "+1 (456) 555-2186", "+12", "+123", "+1-2-3-4-5-6-7-8-9 ", "+1 () 23456789..", "++1 234 567 890", "+1234567890123456", "+1 2345\n67890",
    "+1 (269) 555-3296 4111111111111111 and", "tel+33 1 22 33 44 55 4111 1111 1111 1111", "1 " * 4000, "a" * 20_000 + "@x.y", "1" * 20_000,
    "a.b@" * 3000, "1.1." * 3000, "+1" + " (" * 5000, "a@" + "b." * 5000 + "c", " 7" * 8 + "-" + "7 " * 9,
]


def test_fixed_shapes(spark):
    rng = random.Random(5)
    texts = HARD + ["".join(rng.choice("01 49.-+@()ab_é\n") for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    texts += [" ".join(rng.choice(HARD[:30]) for _ in range(4)) for _ in range(100)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    got = personal.find_personal_data(df).collect()
    for r in got:
        assert [tuple(s) for s in r.base] == plain(texts[r.doc_id]), texts[r.doc_id][:200]
        assert {*r.base} <= {*r.spans} and list(r.spans) == sorted(r.spans)


def test_digest_and_rows(spark):
    docs = messy.documents(spark)
    found = personal.find_personal_data(docs, keep=["doc_id", "text", "start", "row", "kind"])
    got = found.withColumn("sha", F.sha2(personal.named(F.col("base")), 256)).collect()
    assert len(got) == docs.count() and {(r.start, r.row, r.kind) for r in got} == {(5, 3, "k")}
    for r in got:
        assert r.sha == hashlib.sha256(named(plain(r.text)).encode()).hexdigest()


def test_a_context_finds_what_no_shape_fits(spark):
    seeds = [(i, f"lorem call +1 (456) 555-{2000 + i} ipsum and so on", None) for i in range(30)]
    other = [(100 + i, f"dolor item {1000 + i} sit amet", None) for i in range(30)]
    unseen = [(200, "lorem call 555-2186 now", None), (201, "lorem call me now", None), (202, "item 4444 sit", None)]
    df = spark.createDataFrame(seeds + other + unseen, "doc_id long, text string, kind string")
    got = {r.doc_id: ([tuple(s) for s in r.base], [tuple(s) for s in r.spans]) for r in personal.find_personal_data(df).collect()}
    assert got[200] == ([], [(11, 3, 19)])
    assert all(got[i][0] == got[i][1] for i in got if i != 200)


def test_scores_by_hand(spark):
    """One round over a small graph, computed with dictionaries."""
    from gridledger.session import Workspace

    edges = [("before call", f"s{i}", 3) for i in range(4)] + [("before call", "u", None), ("after x", "u", None), ("after x", "s0", 3)]
    got = {r.pattern: r for r in personal._score(spark.createDataFrame(edges, "pattern string, string string, kind int"), Workspace(spark)).collect()}
    score = {f"s{i}": 1.0 for i in range(4)} | {"u": 0.0}
    for _ in range(personal.ROUNDS):
        conf = {p: sum(score[s] for q, s, _ in edges if q == p) / (sum(q == p for q, _, _ in edges) + 1) for p, _, _ in edges}
        score["u"] = 1 - (1 - conf["before call"]) * (1 - conf["after x"])
    assert abs(got["before call"].k3 - conf["before call"]) < 1e-12 and abs(got["after x"].k3 - conf["after x"]) < 1e-12
    assert (got["before call"].seeds_k3, got["after x"].seeds_k3, got["after x"].k0) == (4, 1, 0)


def test_masks(spark):
    df = spark.createDataFrame([("é a@b.co +1 23 456 7890 4111111111111111 z",), ("none",), ("",)], "text string")
    got = [r.t for r in personal.find_personal_data(df, keep=["text"]).select(
        personal.masked(F.col("text"), F.col("spans")).alias("t")).collect()]
    # The phone number's shape takes in the digits that follow it; the card's span only widens the mask.
    assert sorted(got) == sorted(["é <EMAIL> " + got_phone(df.first().text), "none", ""])


def got_phone(text):
    spans = plain(text)
    at, out = spans[0][2] + 1, ""
    for a, k, b in spans[1:]:
        if a >= at:
            out += text[at:a] + f"<{personal.KINDS[k].upper()}>"
        at = max(at, b)
    return out + text[at:]


def test_empty(spark):
    assert personal.find_personal_data(messy.empty(spark)).collect() == []


def test_query_counts_by_kind(spark, tmp_path):
    from gridledger.llm.catalog import QUERIES

    texts = ["a@b.co a@b.de 1.2.3.4", "1.2.3.4 5.6.7.8 9.10.11.12", "4111111111111111 a@b.co +1 23 456 7890", "none", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    for r in QUERIES["op3_personal"](spark, str(tmp_path)).collect():
        spans = plain(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in spans) for i in range(4)]
        assert r.base_sha256 == hashlib.sha256(named(spans).encode()).hexdigest()
