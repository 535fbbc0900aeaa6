import re
from collections import Counter

import messy

from gridledger.llm import quality
from gridledger.llm.quality import Rule


def base(text):
    """Words, code points in words, symbols, repeated lines, words in repeated windows."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(8)}
    lines = [s for s in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


def failed(n, chars, symbols, lines, repeated):
    return n < 20 or 100 * repeated > 30 * n


TEXTS = [
    "a b c d e f g h " * 2, "a b c d e f g h a b c d e f g h a b", "x " * 30, "x " * 7, "one\none\n \n\ntwo\ntwo\ntwo \n",
    "# * $ % & | < > #", "    \u0085 é\U0001f600", "the cat, the Dog.\r\nthe cat, the Dog.\r\n", "\x0b\x0c\t",
    " ".join(f"w{i % 9}" for i in range(90)), " ".join(f"w{i}" for i in range(40)) + " w3 w4 w5 w6 w7 w8 w9 w10 w11 end",
]


def test_measures_equal_plain_python(spark):
    docs = messy.documents(spark).unionByName(
        spark.createDataFrame([(1000 + i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string"), allowMissingColumns=True
    )
    rows = [(r.doc_id, *base(r.text)) for r in docs.collect()]
    want = [(i, *m, failed(*m)) for i, *m in rows]
    got = quality.judge(docs).collect()
    assert sorted(map(str, (tuple(r)[:7] for r in got))) == sorted(map(str, want))
    assert all(not r.kept for r in got if r.base_failed)
    assert all((r.broken == "") == r.kept for r in got)


def test_table_of_rules_decides(spark):
    clean = "the hills of the north are long and the road to them is wet in the days of rain for all that go by it"
    docs = spark.createDataFrame(
        [(0, clean), (1, clean.upper()), (2, clean.replace(" ", " | ")), (3, clean.replace(" ", "!! ")),
         (4, "hügel " * 4 + " ".join(f"wort{i}" for i in range(30))), (5, "\n".join(f"- {w}" for w in clean.split())),
         (6, "the\n" * 4 + "of\n" * 4 + " ".join(f"and{i} on" for i in range(9)))],
        "doc_id long, text string",
    )
    broken = {r.doc_id: r.broken for r in quality.judge(docs).collect()}
    assert broken[0] == ""
    assert "capital letters" in broken[1] and "symbols" in broken[2] and "exclamation marks" in broken[3]
    assert broken[4] == "stop words" and "listed lines" in broken[5] and "repeated lines" in broken[6]
    strict = quality.judge(docs, rules=[Rule("few words", "n_words", low=1000)], base=[]).collect()
    assert {r.broken for r in strict} == {"few words"} and not any(r.base_failed or r.kept for r in strict)
    assert all(r.kept for r in quality.judge(docs, rules=[], base=[]).collect())
    # A divisor of zero is no error.
    assert quality.judge(docs.limit(1).selectExpr("doc_id", "'' AS text"), base=[]).first().broken == ""


def test_empty_table_and_plan(spark):
    out = quality.judge(messy.empty(spark))
    assert out.count() == 0 and out.columns[:3] == ["doc_id", "n_words", "word_chars"]
    plan = quality.judge(messy.documents(spark).coalesce(1))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
