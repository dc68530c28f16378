"""Language identification by multinomial naive Bayes over hashed character n-grams."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binledger.llm.staging import staged

BUCKETS = 1 << 16
LENGTHS = (2, 3)
MAX_LANGUAGES = 512
_AT_ONCE = 1 << 20
_BASES = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], np.uint32)


def has_letter(text):
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _grams(texts, lengths, n_buckets):
    """(place in texts, bucket) of every n-gram of texts in lower case with a blank before
    and behind each, about ``_AT_ONCE`` characters at a time, in the order of the texts. No
    n-gram goes from one text to the next, and none of a long text is lost or counted twice."""
    held, size = [], 0
    for i, text in enumerate(texts):
        padded = f" {text.lower()} "
        for at in range(0, len(padded), _AT_ONCE):
            part = padded[at : at + _AT_ONCE + max(lengths) - 1]
            held.append((i, part, min(_AT_ONCE, len(padded) - at)))
            size += len(part)
            if size >= _AT_ONCE:
                yield from _hashed(held, lengths, n_buckets)
                held, size = [], 0
    if held:
        yield from _hashed(held, lengths, n_buckets)


def _hashed(held, lengths, n_buckets):
    """(place, bucket) of the n-grams of one length that start in the first characters of
    each part, as many as the part says, and end in it."""
    codes = np.frombuffer("".join(part for _, part, _ in held).encode("utf-32-le", "surrogatepass"), np.uint32)
    places, sizes, firsts = (np.array(x, np.int64) for x in zip(*[(i, len(part), n) for i, part, n in held]))
    ends = np.cumsum(sizes)
    owner = np.repeat(places, sizes)
    left = np.repeat(ends, sizes) - np.arange(len(codes))
    own = np.repeat(ends - sizes + firsts, sizes) > np.arange(len(codes))
    value = np.zeros(len(codes), np.uint32)
    for n in range(1, max(lengths) + 1):
        if len(codes) < n:
            return
        size = len(codes) - n + 1
        value = value[:size] * np.uint32(0x01000193) + codes[n - 1 :] * _BASES[(n - 1) % len(_BASES)]
        if n in lengths:
            mixed = value ^ value >> np.uint32(15)
            bucket = (mixed * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - (n_buckets - 1).bit_length())
            inside = own[:size] & (left[:size] >= n)
            yield owner[:size][inside], bucket[inside].astype(np.int64)


def train(
    df: DataFrame,
    text: str = "text",
    label: str = "lang",
    buckets: int = BUCKETS,
    lengths: tuple = LENGTHS,
    smoothing: float = 0.5,
) -> tuple[list[str], np.ndarray]:
    """Labels and their matrix of log probabilities (buckets x labels, float32) from
    all rows that have both text and label.

    Counts are summed on the executors; each task sends at most buckets x labels rows.
    The driver gets the sums, buckets x labels numbers; more than ``MAX_LANGUAGES``
    labels fail. No usable row gives no labels.
    """
    rows = df.select(F.col(f"`{text}`").alias("text"), F.col(f"`{label}`").alias("label")).filter(
        "text is not null and label is not null"
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            by_label: dict[str, list[str]] = {}
            for value, name in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                by_label.setdefault(name, []).append(value)
            for name, texts in by_label.items():
                if name not in sums:
                    if len(sums) >= MAX_LANGUAGES:
                        raise ValueError(f"more than {MAX_LANGUAGES} labels")
                    sums[name] = np.zeros(buckets, np.int64)
                for _, at in _grams(texts, lengths, buckets):
                    sums[name] += np.bincount(at, minlength=buckets)
        for name, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.record_batch(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at], pa.int64())],
                names=["label", "bucket", "n"],
            )

    each = rows.mapInArrow(count, "label string, bucket int, n long")
    counted = staged(each.groupBy("label", "bucket").agg(F.sum("n").alias("n")), "language-counts")
    # One row per label: its counts, bucket by bucket.
    packed = counted.groupBy("label").agg(F.collect_list(F.struct("bucket", "n")).alias("counts"))
    names = sorted(r[0] for r in counted.select("label").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} labels")
    sums = np.zeros((buckets, len(names)))
    place = {name: i for i, name in enumerate(names)}
    for row in packed.toLocalIterator():
        at = np.array([(c["bucket"], c["n"]) for c in row["counts"]])
        sums[at[:, 0], place[row["label"]]] = at[:, 1]
    totals = sums.sum(axis=0) + smoothing * buckets
    return names, np.log((sums + smoothing) / totals).astype(np.float32) if names else sums.astype(np.float32)


def predict(
    df: DataFrame, names: list[str], matrix: np.ndarray, text: str = "text", lengths: tuple = LENGTHS
) -> DataFrame:
    """``df`` with the columns lang_pred and score (the share of the best language in
    the posterior under equal priors, 0 to 1).

    Texts that are missing or without a letter, and all texts if nothing was learned,
    get ``und`` and 0. Equal scores go to the first name. Every text is read whole; a
    column named lang_pred or score is replaced, others pass by. Only the text is used.
    """
    shared = df.sparkSession.sparkContext.broadcast((names, matrix))
    buckets = len(matrix)

    @F.arrow_udf("lang_pred string, score double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names, matrix = shared.value
        columns = np.ascontiguousarray(matrix.T)
        for batch in batches:
            texts = batch.to_pylist()
            named = [i for i, t in enumerate(texts) if t is not None and names]
            # All n-grams of the batch times the matrix: sums of its rows by text.
            total = np.zeros((len(named), len(names)))
            for owner, at in _grams([texts[i] for i in named], lengths, buckets):
                heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else owner
                for k, column in enumerate(columns):
                    total[owner[heads], k] += np.add.reduceat(column[at], heads, dtype=np.float64) if len(at) else 0
            best, share = ["und"] * len(texts), np.zeros(len(texts))
            if named:
                top = total.argmax(axis=1)
                share[named] = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                for i, k in zip(named, top.tolist()):
                    best[i] = names[k]
            yield pa.StructArray.from_arrays([pa.array(best, pa.string()), pa.array(share, pa.float64())], ["lang_pred", "score"])

    column = F.col(f"`{text}`")
    kept = [c for c in df.columns if c not in ("lang_pred", "score")]
    found = scored(F.when(has_letter(column), column))
    return df.withColumn("_found", found).select(*[F.col(f"`{c}`") for c in kept], "_found.lang_pred", "_found.score")
