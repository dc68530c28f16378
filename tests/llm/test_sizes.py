"""What operators leave on disk and hold in memory."""

import random
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from binledger.llm import lines, near, ppm, staging, token_files
from binledger.llm.components import components

P = pytest.importorskip("public_tokenizers")

WORDS = [f"{a}{b}{c}" for a in ("ri", "sto", "la", "clou") for b in ("ver", "ne", "mp") for c in ("s", "ed", "ing", "ly")]


def size_below(folder, pattern):
    return sum(f.stat().st_size for f in Path(folder).rglob(pattern))


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")


def test_shuffles_of_written_tables_are_dropped(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    status = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: sum(b.toString().startswith("shuffle_") for b in _all(status.getAllBlocks()))
    before = shuffled()
    table = staging.staged(spark.range(1000).groupBy((F.col("id") % 97).alias("k")).count(), "counted")
    assert shuffled() <= before and table.count() == 97
    assert spark.conf.get(setting) == "false"  # only while it writes


def _all(blocks):
    return [blocks.apply(i) for i in range(blocks.size())]


def test_written_line_tables_are_no_larger_than_the_lines(spark, monkeypatch, tmp_path):
    rng = random.Random(5)
    monkeypatch.setattr(staging, "shared_folder", lambda _, name: f"{tmp_path}/{name}-{rng.random()}")
    values = ["\n".join(" ".join(f"{rng.randrange(10**6)}x" for _ in range(8)) for _ in range(40)) for _ in range(50)]
    got = lines.dedup_lines(texts(spark, values), runs=True).collect()
    assert len(got) == 50 and not any(r["n_dropped"] for r in got)
    # Marks of a line are 37 hashes of 8 bytes; the line itself is about 60 bytes.
    assert size_below(tmp_path, "line*/*.parquet") < 3 * sum(map(len, values))


def test_edit_distance_ends_early():
    rng = random.Random(3)
    for _ in range(2000):
        a, b = ("".join(rng.choices("abc", k=rng.randrange(14))) for _ in range(2))
        exact = lines.edit_distance(a, b)
        for most in range(15):
            found = lines.edit_distance(a, b, most)
            assert found == exact if exact <= most else found > most


def test_components_make_their_links_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def other(a):
        made.add(1)
        return a + 1

    links = spark.range(0, 100, 2, 2).select(F.col("id").alias("a"), other.asNondeterministic()("id").alias("b"))
    got = {tuple(r) for r in components(links).collect()}
    assert got == {(i, i - i % 2) for i in range(100)}
    assert made.value == 50  # before, 150


@pytest.mark.parametrize("few", [1, 16])
def test_edits_of_many_pairs(monkeypatch, few):
    monkeypatch.setattr(lines, "_FEW", few)
    rng, xs, ys = random.Random(4), [], []
    for size in (0, 1, 63, 64, 65, 130, 300):
        for letters in ("ab", "abcdefgh ", "\u65e5\u672c\u8a9e\U0001d4b3e"):
            for _ in range(12):
                x = rng.choices(letters, k=rng.randrange(size + 1))
                y = list(x)
                for _ in range(rng.randrange(1 + max(1, len(x) // 3))):
                    at = rng.randrange(len(y) + 1)
                    y[at : at + rng.randrange(2)] = rng.choices(letters, k=rng.randrange(2))
                half = rng.choice([0, 0, len(y) // 2])
                xs, ys = [*xs, "".join(x)], [*ys, "".join(y[half:] + y[:half])]
    most = np.array([int(0.2 * max(len(x), len(y))) for x, y in zip(xs, ys)])
    want = [lines.edit_distance(x, y) <= m for x, y, m in zip(xs, ys, most)]
    assert 30 < sum(want) < len(want) - 30
    assert lines.edits_within(xs, ys, most).tolist() == want
    assert lines.edits_within([], [], most[:0]).tolist() == []


def test_keys_of_a_hot_shard_and_labels(spark, monkeypatch):
    """Lines that all share their keys, first one shard, then in lots: the same links."""
    values = [f"the {w} of the same old river by the sea was there again" for w in WORDS]
    rows = spark.createDataFrame([(i, 0, v, len(v), i) for i, v in enumerate(values)], "id long, fp long, norm string, size int, label long")
    keyed = lambda x: lines.marked(x, lines.word_marks, ["label"])
    links = lambda: sorted(map(tuple, near.shard_links(rows, 22, every=True, keyed=keyed, slack=0.2).collect()))
    one = links()
    monkeypatch.setattr(near, "SHARD_NODES", 8)
    monkeypatch.setattr(near, "_SAMPLED", 1)
    assert one and links() == one


def test_pairs_of_a_common_passage_are_not_written(spark, monkeypatch):
    """Lines that share a passage and are not similar, but for a few: the same groups as by
    all their pairs, which are many more than the rows written."""
    rng, n = random.Random(6), 150
    tail = " ".join(rng.choices(WORDS, k=24))
    heads = [" ".join("".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(16)) for _ in range(n)]
    values = [f"{h} {tail}" for h in heads] + [f"{h[:-1]}x {tail}" for h in heads[:6]]
    rows = [(i, rng.getrandbits(62), v, len(v), i, lines.char_counts([v])[0].tobytes()) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "id long, fp long, norm string, size int, label long, counts binary")
    written = []
    monkeypatch.setattr(lines, "staged", lambda df, name: written.append(staging.staged(df, name)) or written[-1])
    got = {tuple(r) for r in components(lines.label_links(df, df, 3, 0.8, True)).collect()}
    keyed = lambda x: lines.marked(x, lines.word_marks, ["label"])
    pairs = staging.staged(near.shard_links(df, 22, every=True, keyed=keyed, slack=1 - 0.8), "pairs")
    assert got == {tuple(r) for r in components(lines.similar(pairs, df, 0.8)).collect()}
    assert {i for i, _ in got} >= {*range(6), *range(n, n + 6)} and len(got) < n
    assert sum(w.count() for w in written) < pairs.count() / 2


def test_grams_are_counted_in_little_memory():
    rng = random.Random(1)
    text = " ".join(rng.choices(WORDS, k=300_000)).encode()
    block = ppm._Block(ppm.ORDER)
    tracemalloc.start()
    for i in range(0, len(text), 1 << 16):
        block.add(None, True, text[i : i + (1 << 16)])
    block._count()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20  # 2 MB of text wait; before, this took 92 MB
    sizes = [len(text[i : i + (1 << 16)].split()) for i in range(0, len(text), 1 << 16)]
    assert sum(map(len, block.rows)) == sum(sizes)
    whole = ppm._Block(ppm.ORDER)
    pieces = [ppm.coded_text(text[i : i + (1 << 16)].split()) for i in range(0, len(text), 1 << 16)]
    grams, counts = np.unique(np.concatenate([g for g, _ in ppm.grams_of(pieces)]), return_counts=True)
    assert not len(whole.grams) and (block.grams == grams).all() and (block.sums == counts).all()


def test_looked_up_columns_copy_no_others():
    n = 50_000
    rows = dict(kind=[1] * n, place=list(range(n))[::-1], gram=list(range(n)), word=[b"x" * 400] * n)
    found = pa.table(rows, schema=pa.schema([("kind", pa.int32()), ("place", pa.int32()), ("gram", pa.int64()), ("word", pa.binary())]))
    outer, pool = pa.default_memory_pool(), pa.system_memory_pool()  # nothing else uses it
    pa.set_memory_pool(pool)
    try:
        (grams,) = ppm.looked_up_columns(found, 1, "gram")
    finally:
        pa.set_memory_pool(outer)
    assert grams.to_pylist() == rows["gram"][::-1]
    assert pool.max_memory() < 4 << 20  # the words are 20 MB


def test_known_pieces_are_bounded():
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        codec = token_files.LibraryCodec(file.read())
    want = codec.encode(["river 7x1 7x2"])[0].tolist()
    for part in range(4):
        codec.encode([" ".join(f"{i:x}q" for i in range(part * 100_000, (part + 1) * 100_000))])
    assert codec.table.count <= 350_000
    assert codec.encode(["river 7x1 7x2"])[0].tolist() == want
