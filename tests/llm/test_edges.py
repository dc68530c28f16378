"""Cases at the edge: very long patterns, tables of numbers, clashing names, added tokens,
and the pipeline as a whole."""

import random
import re
import time
import zlib

import numpy as np
import pytest

from binledger.llm import language, lines, rules, staging, surrogates, tiling, token_files

P = pytest.importorskip("public_tokenizers")
WORDS = ["river", "stone", "lamp", "cloud", "market", "violet", "engine", "harbor", "silver", "garden", "winter", "signal"]


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")


@pytest.mark.parametrize("text, n", [("a@" + "b." * 20_000 + "com", 1), ("abcdefABCDEF" * 100_000, 0), ("a:b:" * 100_000, 0)])
def test_long_patterns_take_linear_time(spark, text, n):
    start = time.time()
    (row,) = surrogates.replace_entities(texts(spark, [text]), "secret").collect()
    assert row["n_entities"] == n and (n or row["text"] == text) and time.time() - start < 60


def test_shortened_addresses_are_still_found(spark):
    values = ["at fe80::1a2b or abcd:ef01:2345:6789:abcd:ef01:2345:6789.", "std::vector a::b face::bed cafe:: 10:30:00"]
    got = [r["n_entities"] for r in surrogates.replace_entities(texts(spark, values), "secret").orderBy("doc_id").collect()]
    assert got == [2, 0]


def test_addresses_never_run_out(spark):
    """Later attempts leave the private range, and are addresses still."""
    rows = [("ip", f"10.0.0.{i}", a) for i in range(40) for a in (0, 3, 4, 15, 16, 63)]
    df = spark.createDataFrame(rows, "kind string, canonical string, attempt int")
    got = df.withColumn("new", surrogates._surrogate("s")).collect()
    assert all(re.fullmatch(r"\d+(\.\d+){3}", r["new"]) and all(int(x) < 256 for x in r["new"].split(".")) for r in got)
    first = {a: {int(r["new"].split(".")[0]) for r in got if r["attempt"] == a} for a in (0, 4, 63)}
    assert first[0] == {10} and min(first[4]) >= 240 and len(first[63]) > 15


def test_clashing_names_pass(spark):
    df = spark.createDataFrame([(1, "Mr. John Smith\nsame line here\nown", "mine", "b"), (2, "same line here\nother", "yours", "c")], "doc_id long, text string, _row string, _drops string")
    for found in (surrogates.replace_entities(df, "s"), lines.dedup_lines(df)):
        assert sorted((r["doc_id"], r["_row"], r["_drops"]) for r in found.collect()) == [(1, "mine", "b"), (2, "yours", "c")]
    assert staging.free_name("_row", df, df) == "__row" and staging.free_name("x", df) == "x"


def test_number_lines_stay(spark):
    """Rows of numbers differ in what they say; only lines with a letter are compared."""
    values = ["2024 | 17\n12.5 900", "1999 | 4\n3.25 18", "2024 | 17\n12.5 900", "on 3 May 2021 at 10:30\nleft 5", "on 4 June 1987 at 22:15\nleft 5"]
    got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(texts(spark, values), runs=True).collect()}
    assert [got[i] for i in range(4)] == values[:4] and got[4].startswith("on 4 June 1987")


def test_many_dropped_lines_take_linear_time(spark):
    body = "\n".join(f"line {WORDS[i % 12]} {i} {WORDS[i // 12 % 12]}{i * 7919}" for i in range(40_000))
    start = time.time()
    got = {r["doc_id"]: r for r in lines.dedup_lines(texts(spark, [body, "x\n" + body])).collect()}
    assert got[0]["text"] == body and got[1]["text"] == "x" and got[1]["n_dropped"] == 40_000
    assert time.time() - start < 120


def test_added_tokens_are_their_ids(spark):
    """As the library's plain call has them, in the midst of words too."""
    from tokenizers import Tokenizer

    json = open(P.path("byte_bpe_50k.json"), encoding="utf-8").read()
    library = Tokenizer.from_str(json)
    values = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y <|endoftext|><|endoftext|>", "plain text", "<|endoftext| >", None]
    got = {r["doc_id"]: r for r in token_files.document_tokens(texts(spark, values), token_files.LibraryCodec(json)).collect()}
    start = 0
    for i, text in enumerate(values):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def corpus():
    """Clean documents of own words, and planted cases: id -> text, ids that go, texts left."""
    draw = random.Random(17)
    sentence = lambda n: " ".join(draw.choice(WORDS) + str(draw.randrange(10_000)) for _ in range(n))
    clean = {i: "\n".join(sentence(30) for _ in range(4)) for i in range(40)}
    left = dict(clean)
    shared = sentence(60)
    passage = sentence(50)
    planted = {
        100: clean[0],  # a copy: all its lines go
        101: "\n".join([sentence(30), shared, sentence(30)]),
        102: "\n".join([sentence(30), shared, sentence(30)]),
        103: "\n".join([sentence(30), passage + " tail", sentence(30)]),  # of the benchmark
        104: "spam " * 200,  # a rule of its own: repeats
        105: "too short",
        106: None,
        107: "",
    }
    left[101], left[102] = planted[101], "\n".join(planted[102].split("\n")[::2])
    return clean | planted, left, passage


def test_the_pipeline_against_planted_cases(spark, tmp_path):
    import corpus_pipeline

    documents, left, passage = corpus()
    schema = "doc_id long, text string, lang string, source string, n_chars long, ids string, _row int"
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "mine", i) for i, t in documents.items()], schema)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = staging.staged(stage(spark, kept, str(tmp_path)), "test-" + name.replace(" ", "-"))
        assert kept.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == left
    assert all(r["_row"] == r["doc_id"] and r["ids"] == "mine" and r["n_chars"] == len(r["text"]) for r in kept.collect())
    got = corpus_pipeline.run(spark, str(tmp_path))
    rows = got.collect()
    assert {r["doc_id"] for r in rows} == set(left) and all(r["round_trip"] for r in rows)
    tiktoken = pytest.importorskip("tiktoken")
    ranks = {__import__("base64").b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in rows:
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode_ordinary(left[r["doc_id"]]) and r["n_tokens"] * 4 == len(r["ids"])


def test_an_empty_corpus(spark, tmp_path):
    import corpus_pipeline

    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    assert rules.STATISTICS


def brute_language(train, texts, buckets, lengths, smoothing):
    """Naive Bayes over the same buckets, one n-gram at a time."""
    import math
    from collections import Counter

    bases = [int(b) for b in language._BASES]

    def grams(text):
        codes = [ord(c) for c in f" {text.lower()} "]
        for n in lengths:
            for i in range(len(codes) - n + 1):
                value = 0
                for k in range(n):
                    value = (value * 0x01000193 + codes[i + k] * bases[k]) % 2**32
                mixed = value ^ value >> 15
                yield (mixed * 0x2C1B3C6D % 2**32) >> (32 - (buckets - 1).bit_length())

    counts = {}
    for label, text in train:
        if label is not None and text is not None:
            counts.setdefault(label, Counter()).update(grams(text))
    names = sorted(counts)
    out = []
    for text in texts:
        if text is None or not re.search(r"[^\W\d_]", text):
            out.append(("und", 0.0))
            continue
        scores = []
        for name in names:
            whole = sum(counts[name].values()) + smoothing * buckets
            scores.append(sum(math.log((counts[name][g] + smoothing) / whole) for g in grams(text)))
        top = max(range(len(names)), key=lambda k: (scores[k], -k))
        out.append((names[top], 1 / sum(math.exp(s - scores[top]) for s in scores)))
    return names, counts, out


def test_language_model_against_brute_force(spark):
    train = [("en", "the cat and the dog"), ("de", "der Hund und die Katze"), ("fr", "le chat et le chien"), ("en", "of this"), (None, "x"), ("fr", None), ("de", "")]
    values = ["the dog", "die katze und", "le chien É", "?", None, "", "ab", "Ünd"] + [t for _, t in train if t]
    names, counts, want = brute_language(train, values, 1 << 10, (2, 3), 0.5)
    df = spark.createDataFrame(train, "lang string, text string")
    scores = []
    for parts in (1, 2, 7):
        found, matrix = language.train(df.repartition(parts), buckets=1 << 10)
        assert found == names
        for k, name in enumerate(names):
            whole = sum(counts[name].values()) + 0.5 * (1 << 10)
            assert np.allclose(matrix[:, k], [np.log((counts[name][g] + 0.5) / whole) for g in range(1 << 10)], atol=1e-6)
        got = language.predict(texts(spark, values).repartition(parts), found, matrix).orderBy("doc_id").collect()
        assert [r["lang_pred"] for r in got] == [w[0] for w in want]
        assert np.allclose([r["score"] for r in got], [w[1] for w in want], atol=1e-4)
        scores.append([r["score"] for r in got])
    assert scores[0] == scores[1] == scores[2]


def test_long_texts_have_every_gram_once(monkeypatch):
    values = ["abc", "", "xyz" * 9, "é"]
    whole = [sorted(zip(o.tolist(), b.tolist())) for o, b in language._grams(values, (2, 3), 1 << 10)]
    monkeypatch.setattr(language, "_AT_ONCE", 5)
    cut = [pair for o, b in language._grams(values, (2, 3), 1 << 10) for pair in zip(o.tolist(), b.tolist())]
    assert sorted(cut) == sorted(pair for found in whole for pair in found)


def test_repeated_words_do_not_multiply(spark):
    """Every window of such an item is that of the document: one match for each diagonal."""
    item, other = "word " * 4000, "one two " * 2000
    start = time.time()
    found = tiling.contaminated(texts(spark, [item, "word " * 2500, other, "clean text here"]), spark.createDataFrame([(1, item), (2, other)], "item_id long, text string"))
    got = sorted((r["doc_id"], r["item_id"], r["covered"], r["n_tiles"]) for r in found.collect())
    assert got == [(0, 1, 4000, 1), (1, 1, 2500, 1), (2, 2, 4000, 1)] and time.time() - start < 60
