"""A small table with what real tables hold: nulls, empty and long texts, copies, ties, clashing names."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, id long, fp long, row int, block int, "
    "start int, kind string, node string, root long, score string, digest string, words array<string>"
)


def documents(spark):
    rng = random.Random(7)
    words = ["the", "cat", "sat", "on", "a", "mat", "Über", "naïve", "x1", "mail", "42", "don't", "日本", "K"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    long = " ".join(rng.choice(words) + str(rng.randint(0, 999)) for _ in range(20_000))
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(100 + i, texts[3]) for i in range(25)]  # copies
    rows += [(200 + i, texts[5] + f" extra{i}") for i in range(10)]  # near copies
    rows += [(300, None), (301, ""), (302, " \n\t "), (303, long), (304, long), (305, "z" * 50_000), (306, "aaa\r\n\r\nbbb  ccc")]
    rows += [(None, texts[3]), (None, None), (7, texts[7]), (7, texts[7]), (8, "another text with the id of a former one")]
    sources = ["hot", "hot", "hot", "small", None, ""]
    return spark.createDataFrame(
        [(i, t, "en", sources[n % 6], None, 1, 2, 3, 4, 5, "k", "n", 6, "s", "d", ["w"]) for n, (i, t) in enumerate(rows)], SCHEMA
    ).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def groups(nodes, pairs):
    """Smallest node reachable from each node."""
    low = {n: n for n in nodes}

    def find(n):
        while low[n] != n:
            n = low[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        low[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
