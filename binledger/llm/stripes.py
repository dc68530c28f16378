"""Frequent phrases by stripes: each phrase keys a counter of the words that come next.

Levels go up one word at a time. A block of texts counts, for each frequent phrase in it,
the words that follow; the stripes of all blocks are merged elementwise. A merged stripe
holds a phrase's extensions and how often each occurs, from which parts, totals and the
most frequent extension follow. Only phrases whose parts are frequent can be frequent, so
each level looks only where the level below found something; nothing is lost by that.
"""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from binledger.llm.staging import staged

#: Occurrences of a phrase per segment of its stripe: the stripe of a very frequent one
#: has many segments, dealt out by the next word.
SEGMENT = 1 << 18
_SALTS = 32
# A word's id is made of the place where it was met: block number and code in the block.
_BLOCK_BITS, _CODE_BITS = 16, 26
_BREAK = b"."
#: The characters that end a piece.
_BREAKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", _BREAK * 10)

_BLOCKS = "block long, lang string, words array<string>, counts array<long>, codes binary"
_GROWN = pa.schema(
    [
        ("block", pa.int64()),
        # a stripe
        ("phrase", pa.int64()),
        ("segment", pa.int32()),
        ("nexts", pa.binary()),
        ("counts", pa.binary()),
        # or what goes on to the next level
        ("words", pa.binary()),
        ("ids", pa.binary()),
        ("phrases", pa.binary()),
        ("phrase_ids", pa.binary()),
    ]
)
_GROWN_TYPES = (
    "block long, phrase long, segment int, nexts binary, counts binary, words binary, ids binary, phrases binary, phrase_ids binary"
)
_MERGED = "block long, phrase long, nexts array<long>, ids array<long>, weights array<long>"


def lower_pieces(data: bytes) -> list:
    """Words of a text lower-cased from A to Z, ``.`` where a piece ends."""
    return data.lower().translate(_BREAKS).replace(_BREAK, b" . ").split()


class _Codes(dict):
    def __missing__(self, word):
        self[word] = code = len(self)
        return code


def text_blocks(df: DataFrame, text: str, lang: str, tokens: int = 1 << 20) -> DataFrame:
    """Texts of one language and task as blocks of about so many words, written: the
    different words, their counts, and the texts as int32 places in that list, -1 between
    pieces. A text is never cut. Each row has a number of its own."""

    def block(number, name, codes, parts):
        flat = np.concatenate(parts)
        flat = np.where(flat == codes[_BREAK], -1, flat).astype("<i4")
        counts = np.bincount(flat[flat >= 0], minlength=len(codes))
        columns = [
            pa.array([number], pa.int64()),
            pa.array([name], pa.string()),
            pa.array([[w.decode() for w in codes]], pa.list_(pa.string())),
            pa.array([counts], pa.list_(pa.int64())),
            pa.array([flat.tobytes()], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["block", "lang", "words", "counts", "codes"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << _BLOCK_BITS
        held = {}
        for batch in batches:
            for name, value in zip(batch.column("lang").to_pylist(), batch.column("text")):
                codes, parts, size = held.get(name) or (_Codes(), [], 0)
                words = lower_pieces(value.as_buffer().to_pybytes())
                words.append(_BREAK)
                parts.append(np.fromiter(map(codes.__getitem__, words), np.int32, len(words)))
                held[name] = codes, parts, size + len(words)
                if size + len(words) >= tokens:
                    yield block(number, name, *held.pop(name)[:2])
                    number += 1
        for name, (codes, parts, _) in held.items():
            yield block(number, name, codes, parts)
            number += 1

    language = F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und"))
    rows = df.select(language.alias("lang"), F.col(f"`{text}`").alias("text"))
    return staged(rows.filter(F.col("text").isNotNull()).mapInArrow(cut, _BLOCKS), "phrase-blocks")


def _looked_up(keys, values, wanted, missing):
    """The values of the wanted keys; ``keys`` ascend."""
    if not len(keys):
        return np.full(len(wanted), missing)
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[place] == wanted, values[place], missing)


def _pairs(a, b, more_a, more_b):
    """One number for each pair (a, b) and (more_a, more_b), equal for equal pairs."""
    x = np.unique(np.concatenate([a, more_a]), return_inverse=True)[1]
    kinds, y = np.unique(np.concatenate([b, more_b]), return_inverse=True)
    number = x.astype(np.int64) * len(kinds) + y
    return number[: len(a)], number[len(a) :]


def _stripe_rows(number, phrase, segments, following):
    """Stripes of one block from phrase, its number of segments, and next word of each place."""
    order = np.lexsort((following, phrase))
    phrase, following, segments = phrase[order], following[order], segments[order]
    at = np.flatnonzero(np.r_[True, (phrase[1:] != phrase[:-1]) | (following[1:] != following[:-1])])
    counts = np.diff(np.r_[at, len(phrase)])
    phrase, following, segments = phrase[at], following[at], segments[at]
    mixed = (following.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    segment = (mixed % segments.astype(np.uint64)).astype(np.int32)
    order = np.lexsort((segment, phrase))
    phrase, segment, following, counts = phrase[order], segment[order], following[order], counts[order]
    heads = np.flatnonzero(np.r_[True, (phrase[1:] != phrase[:-1]) | (segment[1:] != segment[:-1])])
    spans = list(zip(heads.tolist(), np.r_[heads[1:], len(phrase)].tolist()))
    nexts, sizes = following.astype("<i8").tobytes(), counts.astype("<i4").tobytes()
    none = pa.nulls(len(heads), pa.binary())
    columns = [
        pa.array(np.full(len(heads), number, np.int64)),
        pa.array(phrase[heads], pa.int64()),
        pa.array(segment[heads], pa.int32()),
        pa.array([nexts[8 * i : 8 * j] for i, j in spans], pa.binary()),
        pa.array([sizes[4 * i : 4 * j] for i, j in spans], pa.binary()),
    ]
    return pa.Table.from_arrays([*columns, none, none, none, none], schema=_GROWN)


def _grow(state: pa.Table, facts: pa.Table) -> pa.Table:
    """Stripes of one block at the next level, and its state for the level after.

    The state is the block's text as a stream of codes of words, -1 where something was
    left out or a piece ends, with the words' ids, and a stream of the frequent phrases that
    start at each place. At level 1 the facts are code -> id of frequent words; then they are
    (phrase, next) -> id of the block's frequent phrases. Each has its number of segments."""
    if not state.num_rows or not facts.num_rows:
        return _GROWN.empty_table()
    number, n = state["block"][0].as_py(), facts["n"][0].as_py()
    if n == 1:
        words = np.frombuffer(state["codes"][0].as_py(), "<i4")
        code = facts["code"].to_numpy()
        ids = np.full(max(int(words.max()), int(code.max())) + 2, -1)  # that of a break, -1, is the last
        ids[code] = facts["id"].to_numpy()
        segments = np.ones(len(ids), np.int64)
        segments[code] = facts["segments"].to_numpy()
        phrase, many = ids[words], segments[words]
    else:
        words = np.frombuffer(state["words"][0].as_py(), "<i4")
        ids = np.r_[np.frombuffer(state["ids"][0].as_py(), "<i8"), -1]
        starts = np.flatnonzero(words[: 1 - n] >= 0)
        if n == 2:
            before = ids[words[starts]]
        else:
            phrases = np.frombuffer(state["phrases"][0].as_py(), "<i4")
            starts = starts[phrases[starts] >= 0]
            before = np.frombuffer(state["phrase_ids"][0].as_py(), "<i8")[phrases[starts]]
        lists = [facts[c].combine_chunks() for c in ("nexts", "ids", "weights")]
        sizes = np.diff(lists[0].offsets.to_numpy())
        nexts, found, weights = (x.flatten().to_numpy() for x in lists)
        have, want = _pairs(np.repeat(facts["phrase"].to_numpy(), sizes), nexts, before, ids[words[starts + n - 1]])
        order = np.argsort(have)
        phrase, many = np.full(len(words), -1), np.ones(len(words), np.int64)
        phrase[starts] = _looked_up(have[order], found[order], want, -1)
        many[starts] = _looked_up(have[order], weights[order], want, 1)
    # One word more needs a frequent phrase here and one at the next place.
    grows = np.flatnonzero((phrase[:-1] >= 0) & (phrase[1:] >= 0))
    if not len(grows):
        return _GROWN.empty_table()
    stripes = _stripe_rows(number, phrase[grows], many[grows], ids[words[grows + n]])
    needed = np.zeros(len(words) + 1, bool)
    for i in range(n + 1):
        needed[grows + i] = True
    places = np.flatnonzero(needed)
    gap = np.r_[0, np.diff(places) > 1]
    to = np.arange(len(places)) + np.cumsum(gap)
    values = {"block": pa.array([number], pa.int64())}

    def stream(name, ids_name, which):
        """A column of codes with gaps and one of what the codes stand for."""
        kinds, codes = np.unique(which, return_inverse=True)
        codes = codes - (kinds[0] < 0)
        out = np.full(int(to[-1]) + 1, -1, "<i4")
        out[to] = codes
        values[name] = pa.array([out.tobytes()], pa.binary())
        values[ids_name] = pa.array([kinds[kinds >= 0].astype("<i8").tobytes()], pa.binary())

    stream("words", "ids", ids[words[places]])
    if n > 1:
        starting = np.full(len(words), -1)
        starting[grows] = phrase[grows]
        stream("phrases", "phrase_ids", starting[places])
    columns = [values.get(f.name, pa.nulls(1, f.type)) for f in _GROWN]
    return pa.concat_tables([pa.Table.from_arrays(columns, schema=_GROWN), stripes])


def _whole_stripes(batches, least=1 << 22):
    """Frames of about so many bytes with whole stripes, from rows sorted by these."""
    held, size, enough = [], 0, least
    for batch in batches:
        held.append(batch.to_pandas())
        size += batch.nbytes
        if size >= enough:
            frame = pd.concat(held, ignore_index=True)
            last = frame.iloc[-1]
            same = (frame["phrase"] == last["phrase"]) & (frame["segment"] == last["segment"])
            if not same.all():
                yield frame[~same].reset_index(drop=True)
            held = [frame[same]]
            size = int(held[0]["nexts"].map(len).sum() * 1.5)
            enough = max(least, 2 * size)
    if held:
        yield pd.concat(held, ignore_index=True)


def _lists(block, phrase, nexts, ids, weights):
    heads = np.flatnonzero(np.r_[True, (phrase[1:] != phrase[:-1]) | (block[1:] != block[:-1])])
    offsets = pa.array(np.r_[heads, len(phrase)], pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64())) for x in (nexts, ids, weights)]
    blocks = pa.array(block[heads], pa.int64(), mask=block[heads] < 0)
    names = ["block", "phrase", "nexts", "ids", "weights"]
    return pa.RecordBatch.from_arrays([blocks, pa.array(phrase[heads], pa.int64()), *lists], names=names)


def _merged(stripes: DataFrame, least: int) -> DataFrame:
    """The stripes of all blocks added up, what is frequent in them: once without a block,
    with the counts, for the table of phrases, and once for each block that has it, with
    numbers of segments. Ids, those of one level, come from the task and a count in it; both
    uses are one table, so they agree."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        spare = TaskContext.get().partitionId() << 33
        for frame in _whole_stripes(batches):
            row = np.repeat(np.arange(len(frame)), frame["nexts"].map(len).to_numpy(np.int64) // 8)
            following = np.frombuffer(b"".join(frame["nexts"]), "<i8")
            counts = np.frombuffer(b"".join(frame["counts"]), "<i4").astype(np.int64)
            phrase, block = frame["phrase"].to_numpy(), frame["block"].to_numpy()
            order = np.lexsort((following, phrase[row]))
            p, q = phrase[row][order], following[order]
            at = np.flatnonzero(np.r_[True, (p[1:] != p[:-1]) | (q[1:] != q[:-1])])
            sums = np.add.reduceat(counts[order], at)
            kept = sums >= least
            if not kept.any():
                continue
            ids = np.where(kept, spare + np.cumsum(kept) - 1, -1)
            spare += int(kept.sum())
            first = at[kept]
            yield _lists(np.full(len(first), -1), p[first], q[first], ids[kept], sums[kept])
            entry = np.repeat(np.arange(len(at)), np.diff(np.r_[at, len(order)]))
            back = np.flatnonzero(kept[entry])
            back = back[np.argsort(row[order][back], kind="stable")]
            who, entry = row[order][back], entry[back]
            yield _lists(block[who], p[back], q[back], ids[entry], 1 + sums[entry] // SEGMENT)

    sorted_stripes = stripes.repartition("phrase", "segment").sortWithinPartitions("phrase", "segment")
    return staged(sorted_stripes.mapInArrow(merge, _MERGED), "phrase-stripes")


def frequent_phrases(blocks: DataFrame, least: int = 30, longest: int = 4) -> DataFrame:
    """Phrases of 1 to ``longest`` words that stand at least ``least`` times in the texts of
    a language (``text_blocks``), overlaps counted, no punctuation inside: lang, words, f,
    heads and tails (how often its first 1, 2, ... words occur, and its last 1, 2, ...), id
    among the phrases of as many words, prefix and suffix (ids of the phrase without its
    last and without its first word)."""
    listed = blocks.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("code", "w"))
    place = F.col("block") * F.lit(1 << _CODE_BITS) + F.col("code")
    same = Window.partitionBy("lang", "word")
    # A word has a row for each block; one shuffle brings them together, and the first of
    # its places is its id.
    counted = (
        listed.select("block", "lang", "code", F.col("w.words").alias("word"), F.col("w.counts").alias("n"), place.alias("place"))
        .select("*", F.sum("n").over(same).alias("f"), F.min("place").over(same).alias("id"))
        .filter(F.col("f") >= least)
    )
    once = F.col("place") == F.col("id")
    met = counted.select(
        "block", "code", "id", F.when(once, F.col("lang")).alias("lang"), F.when(once, F.col("word")).alias("word"), "f"
    )
    met = staged(met, "phrase-words")
    empty, none = F.array().cast("array<bigint>"), F.lit(None).cast("long")
    words = met.filter("lang is not null").select(
        "lang", F.array("word").alias("words"), "f", empty.alias("heads"), empty.alias("tails"), "id",
        none.alias("prefix"), none.alias("suffix"), none.alias("next"),
    )
    levels = [words]
    state = blocks.select("block", "codes")
    segments = F.floor(F.col("f") / SEGMENT) + 1
    facts = met.select("block", "code", "id", segments.alias("segments"), F.lit(1).alias("n"))
    for n in range(1, longest):
        both = state.groupBy("block").cogroup(facts.groupBy("block")).applyInArrow(_grow, _GROWN_TYPES)
        grown = staged(both, "phrase-level")
        merged = _merged(grown.filter("phrase is not null").select("block", "phrase", "segment", "nexts", "counts"), least)
        entry = F.inline(F.arrays_zip(F.col("nexts").alias("next"), F.col("ids").alias("id"), F.col("weights").alias("total")))
        found = merged.filter("block is null").select("phrase", entry)
        levels.append(staged(_named(found, levels[-1], n), "phrase-table"))
        state = grown.filter("phrase is null").select("block", "words", "ids", "phrases", "phrase_ids")
        facts = merged.filter("block is not null").select("block", "phrase", "nexts", "ids", "weights", F.lit(n + 1).alias("n"))
    return reduce(DataFrame.unionByName, levels).drop("next")


def _named(found, below, n):
    """The phrases of n + 1 words with words, parts and their counts, from those of n."""
    head = below.select(
        F.col("id").alias("phrase"), "lang", F.col("words").alias("_words"), F.col("f").alias("_f"), F.col("heads").alias("_heads"),
        F.col("suffix").alias("_suffix"),
    )
    tail = below.select(
        F.col("id").alias("suffix"), F.element_at("words", -1).alias("_last"), F.col("f").alias("_tail_f"), F.col("tails").alias("_tails"),
        *([] if n == 1 else [F.col("prefix").alias("_of"), F.col("next").alias("_next")]),
    )
    started = found.join(head, "phrase")
    same = started["next"] == tail["suffix"]
    if n > 1:
        same = (started["_suffix"] == tail["_of"]) & (started["next"] == tail["_next"])
    return started.join(tail, same).select(
        "lang", F.concat("_words", F.array("_last")).alias("words"), F.col("total").alias("f"),
        F.concat("_heads", F.array("_f")).alias("heads"), F.concat("_tails", F.array("_tail_f")).alias("tails"),
        "id", F.col("phrase").alias("prefix"), "suffix", "next",
    )


def collocations(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = 30,
    longest: int = 4,
    top: int = 2000,
    scale: int = 2_000_000,
    inside: int = 80,
) -> DataFrame:
    """Each language's first ``top`` phrases of 2 to ``longest`` words that occur ``least``
    times or more: lang, rank, phrase, a (occurrences), l and r (those of its two parts at
    the cut with the lowest score, the first of equal ones), n (all words of the language),
    score: floor(scale * a / (l + r)).

    Words are what stands between blanks and tabs, lower-cased from A to Z; the characters
    ``.,;:!?`` and line ends cut a text into pieces, and no phrase crosses them; occurrences
    may overlap. Ranked by score and a, both descending, then phrase in the order of its
    bytes. A phrase inside a longer one that has at least ``inside`` percent of its
    occurrences is left out; as longer phrases are never more frequent, those of one word
    more decide that. Arithmetic is exact.

    A missing language is ``und``. Missing and empty texts have no words. Other columns are
    not read; repeated rows count as often as they occur; no rows give no rows.
    """
    blocks = text_blocks(df, text, lang)
    all_words = F.aggregate("counts", F.lit(0).cast("long"), lambda total, n: total + n)
    totals = blocks.groupBy("lang").agg(F.sum(all_words).alias("n"))  # one row per language
    phrases = staged(frequent_phrases(blocks, least, longest), "phrases")
    n_words = F.size("words")
    longer = [phrases.filter(n_words > 2).select((n_words - 1).alias("n_words"), F.col(side).alias("id"), "f") for side in ("prefix", "suffix")]
    covers = longer[0].union(longer[1]).groupBy("n_words", "id").agg(F.max("f").alias("_longer"))
    outside = F.coalesce(100 * F.col("_longer") < inside * F.col("f"), F.lit(True))
    candidates = phrases.filter(n_words > 1).withColumn("n_words", n_words).join(covers, ["n_words", "id"], "left").filter(outside)
    # heads[k - 1] and the k-th last of tails belong to the cut after k words.
    score = f"cast({int(scale)} * cast(f as decimal(19,0)) div cast(head + tails[size(tails) - 1 - k] as decimal(20,0)) as bigint)"
    cut = f"transform(heads, (head, k) -> struct({score} as score, k, head as l, tails[size(tails) - 1 - k] as r))"
    scored = candidates.select(
        "lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), F.expr(f"array_min({cut})").alias("cut")
    ).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # The first of each share of a language's phrases, then the first of those.
    order = [F.desc("score"), F.desc("a"), "phrase"]
    share = F.pmod(F.xxhash64("phrase"), F.lit(_SALTS)).alias("_share")
    shares = scored.select("*", share).withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_share").orderBy(*order)))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    ranked = shares.filter(F.col("_place") <= top).withColumn("rank", place).filter(F.col("rank") <= top)
    return ranked.join(F.broadcast(totals), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
