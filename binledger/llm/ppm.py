"""Language-model scores by prediction by partial matching (PPM) over bytes.

A text is its words, lower-cased from A to Z, each coded byte by byte with the space
behind it, and an end sign. The context of a byte is what precedes it in the text, from
the space before the first word on, ``ORDER`` bytes at most. Counts of the training texts form a trie
of contexts. A byte is coded in the longest context seen; if it never followed there, an
escape is coded (method C: as often as different bytes followed) and the next shorter
context is tried, without the bytes that the longer one would have coded; last comes an
equal share of the bytes never seen. So the probabilities of all texts add up to one.

No table of words or contexts is broadcast. Documents are coded in blocks against each
block's own words; the words and contexts of all blocks are looked up by joins.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binledger.llm.staging import shared_folder, staged

ORDER = 5
BLOCK_BYTES = 48 << 20
_AT_ONCE = 1 << 20
_GRAMS = 1 << 18
_BLOCKS = "kind int, block long, place int, word binary, gram long, n long, id {key}, train boolean, tokens binary"


def coded_text(words: list[bytes]) -> bytes:
    """What is coded for the words of a text: all but the first byte."""
    return b" ".join([b"", *words, b"\n"])


def grams_of(texts: list[bytes], order: int = ORDER) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every byte coded: its context and itself packed in one number (the number of
    context bytes in the top byte), and the place of its text; in pieces."""
    data, lengths = np.frombuffer(b"".join(texts), np.uint8), np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.cumsum(lengths) - lengths
    for at in range(0, len(data), _GRAMS):
        piece = data[max(at - order, 0) : at + _GRAMS].astype(np.int64)
        place = np.arange(at, min(at + _GRAMS, len(data)))
        of = np.searchsorted(begins, place, side="right") - 1
        depth = np.minimum(place - begins[of], order)
        skip = len(piece) - len(place)
        out = piece[skip:].copy()
        for k in range(1, order + 1):
            before = np.zeros(len(place), np.int64)
            lost = max(k - skip, 0)
            before[lost:] = piece[skip - k + lost : len(piece) - k]
            out |= np.where(depth >= k, before << 8 * k, 0)
        coded = depth > 0
        yield (out | depth << 56)[coded], of[coded]


def code_lengths(grams: np.ndarray, counts: np.ndarray, order0: np.ndarray) -> np.ndarray:
    """log10 probability of each gram's byte after its context.

    ``grams`` are all those whose contexts end with the same byte, ``counts`` how often
    the training texts have them, ``order0`` the counts of the 256 bytes.
    """
    depth, symbol = grams >> 56, grams & 0xFF
    context = grams >> 8 & (1 << 48) - 1
    seen = counts > 0
    log, open_ = np.zeros(len(grams)), np.ones(len(grams), bool)
    levels = []
    for k in range(1, int(depth.max(initial=0)) + 1):
        at = np.flatnonzero(depth >= k)
        pair = (context[at] & (1 << 8 * k) - 1) << 8 | symbol[at]
        known = seen[at]
        pairs, of = np.unique(pair[known], return_inverse=True)
        c = np.bincount(of, counts[at][known], len(pairs))
        nodes, node = np.unique(pairs >> 8, return_inverse=True)
        total, different = np.bincount(node, c, len(nodes)), np.bincount(node, minlength=len(nodes))
        if k == 1:
            shorter = order0[pairs & 0xFF]
        else:
            shorter = levels[-1]["c"][np.searchsorted(levels[-1]["pairs"], pairs & (1 << 8 * k) - 1)]
        # What the bytes that follow here count in the next shorter context.
        levels.append(dict(at=at, pair=pair, pairs=pairs, c=c, nodes=nodes, total=total, different=different, below=np.bincount(node, shorter, len(nodes))))
    gone, gone_kinds = np.zeros(len(grams)), np.zeros(len(grams))

    def step(who, has, count, total, different):
        """Code in one context, or an escape from it."""
        rest = total - gone[who] + different - gone_kinds[who]
        log[who[has]] += np.log10(count[has] / rest[has])
        out = ~has & (rest > 0)
        log[who[out]] += np.log10((different - gone_kinds[who])[out] / rest[out])
        open_[who[has]] = False

    for x in reversed(levels):
        if not len(x["nodes"]):
            continue
        place = np.minimum(np.searchsorted(x["nodes"], x["pair"] >> 8), len(x["nodes"]) - 1)
        ok = open_[x["at"]] & (x["nodes"][place] == x["pair"] >> 8)
        who, pair, place = x["at"][ok], x["pair"][ok], place[ok]
        found = np.minimum(np.searchsorted(x["pairs"], pair), len(x["pairs"]) - 1)
        step(who, x["pairs"][found] == pair, x["c"][found], x["total"][place], x["different"][place])
        gone[who], gone_kinds[who] = x["below"][place], x["different"][place]
    who = np.flatnonzero(open_)
    c = order0[symbol[who]]
    step(who, c > 0, c, np.full(len(who), order0.sum()), np.full(len(who), (order0 > 0).sum()))
    who = np.flatnonzero(open_)
    log[who] -= np.log10(256 - (order0 > 0).sum()) if len(who) else 0
    return log


class _Block:
    """Documents gathered by one task until they are as large as a block; what is held
    are numbers of words, and sums."""

    def __init__(self, order):
        self.order, self.size = order, 0
        self.keys, self.train, self.rows, self.place = [], [], [], {}
        self.n, self.every = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.grams, self.sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.texts, self.waiting = {True: [], False: []}, 0

    def add(self, key, train, text):
        words = text.lower().split()  # at 0x20 and 0x09 to 0x0D
        new = list(dict.fromkeys(w for w in words if w not in self.place))
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
        row = np.fromiter(map(self.place.__getitem__, words), np.uint32, len(words))
        while len(self.place) > len(self.n):
            self.n, self.every = (np.concatenate([x, np.zeros_like(x)]) for x in (self.n, self.every))
        at, times = np.unique(row, return_counts=True)
        self.every[at] += times
        self.n[at] += times * train
        self.keys.append(key)
        self.train.append(train)
        self.rows.append(row)
        self.texts[train].append(coded_text(words))
        self.waiting += len(text)
        self.size += len(text)
        if self.waiting >= 2 * _AT_ONCE:
            self._count()

    def _count(self):
        for train, texts in self.texts.items():
            # Counted piece by piece: all grams of the texts are many times the texts.
            found = [np.unique(grams, return_counts=True) for grams, _ in grams_of(texts, self.order)]
            found = [np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*found) if found else ((), ()))]
            grams, of = np.unique(found[0], return_inverse=True)
            counts = np.zeros(len(grams), np.int64)
            np.add.at(counts, of, found[1])
            every = np.unique(np.concatenate([self.grams, grams]))
            sums = np.zeros(len(every), np.int64)
            sums[np.searchsorted(every, self.grams)] = self.sums
            if train:
                sums[np.searchsorted(every, grams)] += counts
            self.grams, self.sums = every, sums
        self.texts, self.waiting = {True: [], False: []}, 0

    def batches(self, number, key_type):
        """The block's rows for the written table."""
        self._count()
        m, g, d = len(self.place), len(self.grams), len(self.keys)
        # Frequent words first, so that documents are small numbers mostly.
        order = np.argsort(-self.every[:m], kind="stable")
        rank = np.empty(m, np.uint32)
        rank[order] = np.arange(m, dtype=np.uint32)
        words = list(self.place)

        def batch(kind, size, **given):
            given |= dict(kind=pa.array([kind] * size, pa.int32()), block=pa.array([number] * size, pa.int64()))
            types = dict(place=pa.int32(), word=pa.binary(), gram=pa.int64(), n=pa.int64(), id=key_type, train=pa.bool_(), tokens=pa.binary())
            names = ["kind", "block", *types]
            return pa.RecordBatch.from_arrays([given.get(c) if c in given else pa.nulls(size, types[c]) for c in names], names=names)

        step = 50_000
        for a in range(0, m, step):
            part = order[a : a + step]
            yield batch(0, len(part), place=pa.array(np.arange(a, a + len(part), dtype=np.int32)), word=pa.array([words[i] for i in part], pa.binary()), n=pa.array(self.n[part]))
        for a in range(0, g, step):
            part = self.grams[a : a + step]
            yield batch(1, len(part), place=pa.array(np.arange(a, a + len(part), dtype=np.int32)), gram=pa.array(part), n=pa.array(self.sums[a : a + step]))
        for a in range(0, d, 1000):
            some = self.rows[a : a + 1000]
            # Byte planes: the first of all numbers, the second of all, ...
            tokens = [rank[r].astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for r in some]
            keys = pa.array([k.as_py() for k in self.keys[a : a + 1000]], key_type)
            yield batch(2, len(some), id=keys, train=pa.array(self.train[a : a + 1000], pa.bool_()), tokens=pa.array(tokens, pa.binary()))


def looked_up_columns(found: pa.Table, kind: int, *columns: str) -> list[pa.ChunkedArray]:
    """Columns of the rows of one kind, by place; no other column is copied."""
    part = found.select(["place", *columns]).filter(pc.equal(found.column("kind"), kind))
    order = pc.sort_indices(part.column("place"))
    return [part.column(c).take(order) for c in columns]


def ppm_scores(df: DataFrame, train, key: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """One row per row of ``df``: key, train, n_tokens, n_known, train_tokens, base_score and
    score.

    Tokens are the words of the text and one end. The model, and the counts c of each
    token, N of all and V of the different ones, come from the rows for which the column
    ``train`` is true. n_known: tokens with c > 0; train_tokens: N; base_score: sum of
    log10((c + 1) / (N + V + 1)); score: log10 of the PPM probability of the text. A
    missing text counts as empty and is its end alone; rows with a missing ``train`` are
    not learned from; copies count each time; no rows give no rows, and with nothing to
    learn from every byte is equally likely. Other columns are not read.

    The texts are read once, into a table of blocks in the shared folder; a word or
    context is a row once per block. Words and contexts are summed before they are
    shuffled; those that occur in all blocks are a side that adaptive execution may split.
    """
    if not 1 <= order <= 6:
        raise ValueError("contexts of 1 to 6 bytes")
    spark = df.sparkSession
    kind = df.schema[key].dataType.simpleString()
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = df.select(F.col(f"`{key}`").alias("id"), F.coalesce(train, F.lit(False)).alias("train"), value.alias("text"))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, number, key_type = _Block(order), TaskContext.get().partitionId() << 32, None
        for batch in batches:
            key_type = batch.column(0).type
            for i in range(batch.num_rows):
                block.add(batch.column(0)[i], batch.column(1)[i].as_py(), batch.column(2)[i].as_buffer().to_pybytes())
                if block.size >= BLOCK_BYTES:
                    yield from block.batches(number, key_type)
                    block, number = _Block(order), number + 1
                    pa.default_memory_pool().release_unused()
        if block.keys:
            yield from block.batches(number, key_type)
        pa.default_memory_pool().release_unused()  # workers live on

    # A word or context is a row for every block that has it, so blocks are large.
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = rows.coalesce(max(-(-total // BLOCK_BYTES), spark.sparkContext.defaultParallelism))
    folder, schema = shared_folder(spark, "ppm-blocks"), _BLOCKS.format(key=kind)
    rows.mapInArrow(code, schema).write.partitionBy("kind").option("compression", "zstd").parquet(folder)
    blocks = lambda: spark.read.schema(schema).parquet(folder)  # noqa: E731  (each with columns of its own)
    words = blocks().filter("kind = 0").select("block", "place", "word", "n")
    grams = blocks().filter("kind = 1").select("block", "place", "gram", "n")
    documents = blocks().filter("kind = 2").select("block", "id", "train", "tokens")
    counts = staged(words.groupBy("word").agg(F.sum("n").alias("c")), "ppm-words")
    n_words, v_words = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1))).first()
    n_ends = documents.filter("train").count()
    n_all, v_all = n_words + n_ends, v_words + (n_ends > 0)
    sums = grams.groupBy("gram").agg(F.sum("n").alias("n"))
    order0 = np.zeros(256)
    for row in grams.groupBy(F.expr("gram & 255").alias("byte")).agg(F.sum("n").alias("n")).collect():  # 256 rows
        order0[row["byte"]] = row["n"]

    def trie(frame: pd.DataFrame) -> pd.DataFrame:
        gram = frame["gram"].to_numpy()
        return pd.DataFrame({"gram": gram, "value": code_lengths(gram, frame["n"].to_numpy().astype(float), order0).astype(np.float32)})

    coded = sums.groupBy(F.expr("gram >> 8 & 255")).applyInPandas(trie, "gram long, value float")
    of_words = words.join(counts, "word").select(F.col("block").alias("of_block"), F.lit(0).alias("kind"), "place", "c", F.lit(None).cast("float").alias("value"), "word", F.lit(None).cast("long").alias("gram"))
    of_grams = grams.join(coded, "gram").select(F.col("block").alias("of_block"), F.lit(1).alias("kind"), "place", F.lit(None).cast("long").alias("c"), "value", F.lit(None).cast("binary").alias("word"), "gram")
    looked_up = of_words.unionByName(of_grams)

    def score(documents: pa.Table, found: pa.Table) -> pa.Table:
        c, names = looked_up_columns(found, 0, "c", "word")
        log_of, grams = looked_up_columns(found, 1, "value", "gram")
        del found
        c, names, log_of, grams = c.to_numpy(), names.to_pylist(), log_of.to_numpy().astype(float), grams.to_numpy()
        base, known, out, held, size = np.log10(c + 1), c > 0, [], [], 0

        def coded():
            total = np.zeros(len(held))
            for gram, text in grams_of(held, order):
                total += np.bincount(text, log_of[np.searchsorted(grams, gram)], len(held))
            return total.tolist()

        totals = []
        for packed in documents.column("tokens"):
            row = np.frombuffer(packed.as_buffer(), np.uint8).reshape(4, -1).T.copy().view("<u4").reshape(-1)
            n = len(row) + 1
            end = np.log10(n_ends + 1) - n * np.log10(n_all + v_all + 1)
            out.append((n, int(known[row].sum()) + int(n_ends > 0), float(base[row].sum() + end)))
            held.append(coded_text([names[i] for i in row.tolist()]))
            size += len(held[-1])
            if size >= _AT_ONCE:
                totals += coded()
                held, size = [], 0
        totals += coded() if held else []
        n, n_known, base_score = zip(*out) if out else [()] * 3
        pa.default_memory_pool().release_unused()  # workers live on
        return pa.table(
            {
                key: documents.column("id"),
                "train": documents.column("train"),
                "n_tokens": pa.array(n, pa.int64()),
                "n_known": pa.array(n_known, pa.int64()),
                "train_tokens": pa.array([n_all] * len(out), pa.int64()),
                "base_score": pa.array(base_score, pa.float64()),
                "score": pa.array(totals, pa.float64()),
            }
        )

    result = f"`{key}` {kind}, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return documents.groupBy("block").cogroup(looked_up.groupBy("of_block")).applyInArrow(score, result)
