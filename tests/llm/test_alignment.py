import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from binledger.llm import alignment, entry

public_tokenizers = pytest.importorskip("public_tokenizers")

TYPES = "doc_id long, text string"
TEXTS = [
    "Hello world, this is a test.",
    " leading and trailing ",
    "  two  spaces\n\nand lines \n x\t tab \r\n end",
    "",
    None,
    "a ▁ literal mark",
    "▁",
    " ",
    "\n\n",
    "<|endoftext|> and <s> </s> <unk> <0x0A> stay text <|endoftext|>",
    "Ünïcödé naïve 日本語 テスト 🎉🎉 ﬁ é  nbsp em \x00 nul \x07",
    "the the the " * 50,
    "Hello world, this is a test.",
    "supercalifragilisticexpialidocious antidisestablishmentarianism",
    "x" * 3000 + " " * 300 + "y",
    "1234567890 3.14159 1e10",
]


@pytest.fixture(scope="module")
def codecs():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        a = alignment.ByteLevelCodec(file.read())
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return a, alignment.PieceModelCodec(file.read())


def brute_force(texts, codecs):
    """Encodes whole texts with the libraries and cuts where both have a token's end."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_str(codecs[0].json), SentencePieceProcessor(model_proto=codecs[1].model)
    a.encode_special_tokens = True
    characters = alignment.byte_characters()
    docs, counts = [], Counter()
    for text in texts:
        ids = a.encode(" " + text, add_special_tokens=False).ids if text else []
        others = b.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        parts = [bytes(characters[c] for c in a.id_to_token(i)) for i in ids]
        pieces = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(others, b.id_to_piece(others))]
        if not text or b"".join(parts) != whole or b"".join(pieces) != whole:
            docs.append(([], [], [], []))
            continue
        ends, other_ends = np.cumsum([len(p) for p in parts]).tolist(), np.cumsum([len(p) for p in pieces]).tolist()
        groups, i, j = [], 0, 0
        for end in sorted(set(ends) & set(other_ends)):
            k, m = ends.index(end, i) + 1, other_ends.index(end, j) + 1
            groups.append((ids[i:k], others[j:m]))
            i, j = k, m
        links = [(x, y) for x, e in zip(ids, ends) for y, f in zip(others, other_ends) if e == f] if len(ids) < 500 else [(g[0][-1], g[1][-1]) for g in groups]
        counts.update(links)
        docs.append((ids, others, groups, links))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    out = []
    for ids, others, groups, links in docs:
        name = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        digest = hashlib.sha256(name.encode()).hexdigest() if ids else ""
        n_best = sum(counts[x, y] == best[y] for x, y in links)
        out.append((len(ids), len(others), len(groups), len(links), n_best, sum(counts[link] for link in links), digest))
    return out


def run(spark, texts, monkeypatch, tmp_path, parts=3):
    folder = tmp_path / str(random.random())
    folder.mkdir()
    df = spark.createDataFrame(list(enumerate(texts)), TYPES).repartition(parts)
    df.write.parquet(f"{folder}/documents.parquet")
    got = entry.op12_aligned_tokens(spark, str(folder))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return [tuple(r)[1:] for r in sorted(got.collect())]


def test_query_against_whole_texts(spark, codecs, monkeypatch, tmp_path):
    assert run(spark, TEXTS, monkeypatch, tmp_path) == brute_force(TEXTS, codecs)


def test_random_texts(spark, codecs, monkeypatch, tmp_path):
    draw = random.Random(11)
    alphabet = ["a", "e", "th", "ing", " ", " ", "  ", "\n", "\t", "é", "ß", "日", "▁", "'s", "12", ".", "<s>", "🎉", " ", "　"]
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.randint(1, 120))) for _ in range(150)]
    texts += [t.replace("▁", "") for t in texts]
    assert run(spark, texts, monkeypatch, tmp_path) == brute_force(texts, codecs)


def test_groups_links_and_clashing_columns(spark, codecs):
    df = spark.createDataFrame([(1, "Hello worldly", 5, "mine"), (1, "Hello worldly", 6, "mine"), (None, None, 7, None)], "key int, text string, links int, n_best string")
    aligned = alignment.align_tokens(df, *codecs)
    assert aligned.columns == ["key", "n_best", "groups", "links", "n_a", "n_b", "n_groups", "n_links"]
    first, second, missing = sorted(aligned.collect(), key=lambda r: (r["key"] is None, r["groups"]))
    assert first == second and first["groups"].count(";") == first["n_groups"] - 1
    assert missing["groups"] == "" and missing["n_links"] == 0 and bytes(missing["links"]) == b""
    pairs = alignment.possible_pairs(codecs[0].open().token_bytes, codecs[1].open().token_bytes)
    counts = alignment.link_counts(aligned)
    assert {r["n"] for r in counts.collect()} == {2}
    scored = alignment.best_links(aligned, counts, pairs)
    assert sorted((r["n_best"], r["count_sum"]) for r in scored.collect()) == [(0, 0)] + [(first["n_links"], 2 * first["n_links"])] * 2


def test_long_chains_of_pointers():
    """Tokens of two bytes, shifted by one on the other side: one group of all."""
    a_ends = np.r_[np.arange(2, 20_000, 2), 20_000]
    b_ends = np.r_[np.arange(1, 20_000, 2), 20_000]
    of_a, of_b = alignment.terminals(a_ends, b_ends)
    assert set(of_a.tolist()) == set(of_b.tolist()) == {len(b_ends) - 1}


def test_possible_pairs_are_bounded(codecs):
    a, b = (c.open().token_bytes for c in codecs)
    pairs = alignment.possible_pairs(a, b)
    assert len(pairs) <= 2 * sum(map(len, a)) + sum(map(len, b)) < 1_000_000
    for pair in pairs[:: len(pairs) // 500].tolist():
        x, y = a[pair >> 32], b[pair & 0xFFFFFFFF]
        assert x.endswith(y) or y.endswith(x)


def test_forgetting_pieces_changes_nothing(codecs):
    texts = [t for t in TEXTS if t]
    whole = alignment.Aligner(*codecs).align(texts)
    forgetful = alignment.Aligner(*codecs, most=3)
    parts = [forgetful.align([t]) for t in texts]
    assert [p.to_pylist()[0] for p in parts] == whole.to_pylist()


def test_no_rows(spark, codecs):
    aligned = alignment.align_tokens(spark.createDataFrame([], TYPES), *codecs)
    pairs = alignment.possible_pairs(codecs[0].open().token_bytes, codecs[1].open().token_bytes)
    assert alignment.best_links(aligned, alignment.link_counts(aligned), pairs).collect() == []
