import re
from collections import Counter, defaultdict

import pytest

from binledger.llm import entry, stripes

TYPES = "doc_id long, text string, lang string"


def brute_force(rows, least, longest, top, scale, inside):
    """Counts every phrase of every language and applies the rules one by one."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang, lowered = lang or "und", (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        scored = []
        for p, a in candidates.items():
            longer = [q for q in candidates if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * candidates[q] >= inside * a for q in longer):
                continue
            score, k = min((scale * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def compared(spark, rows, least=2, longest=4, top=2000, scale=2_000_000, inside=80, parts=3):
    df = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], TYPES).repartition(parts)
    got = stripes.collocations(df, least=least, longest=longest, top=top, scale=scale, inside=inside)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = sorted(tuple(r) for r in got.collect())
    assert got == brute_force(rows, least, longest, top, scale, inside)
    return got


ROWS = [
    ("en", "New York is big. new york Is big, new york is\tbig; york new"),
    ("en", "a a a a a a b a a a a c"),
    ("de", "Élan élan New York\nNew York is big"),
    (None, "x y z x y z x y z? x\x0by x\x0cy\rx y"),
    (None, None),
    ("fr", ""),
    ("fr", " .,;:!? \n"),
    ("en", "word \x00 word \x00 |word ,word   word   word   word"),
    ("de", "Élan élan New York\nNew York is big"),
]


def test_rules(spark):
    assert len(compared(spark, ROWS)) > 10


@pytest.mark.parametrize("least, longest, top, inside", [(1, 2, 3, 80), (2, 3, 2000, 100), (3, 4, 5, 50), (2, 6, 2000, 101)])
def test_settings(spark, least, longest, top, inside):
    compared(spark, ROWS, least=least, longest=longest, top=top, inside=inside)


def test_large_scores_are_exact(spark):
    compared(spark, ROWS, scale=10**18)


def test_blocks_and_segments(spark, monkeypatch):
    """Small blocks, many segments of a stripe and short frames change nothing."""
    import random

    draw = random.Random(5)
    rows = [("en", " ".join(draw.choice("the the the of a b c d e f".split()) for _ in range(40))) for _ in range(30)]
    monkeypatch.setattr(stripes, "SEGMENT", 8)
    whole = stripes.text_blocks
    monkeypatch.setattr(stripes, "text_blocks", lambda df, text, lang: whole(df, text, lang, tokens=100))
    compared(spark, rows, least=4)


def test_ties_copies_and_other_columns(spark):
    rows = [("en", "b c. a b. c a. a b. b c. c a")] * 4
    df = spark.createDataFrame([(1, "x", t, lang) for lang, t in rows], "phrase int, block string, text string, lang string")
    got = sorted(tuple(r) for r in stripes.collocations(df).collect())
    assert got == brute_force(rows, 30, 4, 2000, 2_000_000, 80) == []
    got = sorted(tuple(r) for r in stripes.collocations(df, least=8).collect())
    assert got == brute_force(rows, 8, 4, 2000, 2_000_000, 80) and len(got) == 3


def test_no_rows(spark):
    assert stripes.collocations(spark.createDataFrame([], TYPES)).collect() == []


def test_very_long_text(spark):
    compared(spark, [("en", "spam ham eggs " * 100_000), ("en", "x" * 1_000_000)], least=30)


def test_query_is_registered():
    assert "op11_collocations" in entry.queries() and "op11_collocations" in entry.oracle_sql()
