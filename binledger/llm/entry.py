"""The queries of this subpackage and their SQL, for ``__spark_entry__.py``."""

from pyspark.sql import functions as F

from binledger.llm.staging import small_batches, staged

TOKENIZERS = "byte_bpe_50k"
PIECES = "piece_bpe_32k"


def _read(spark, sf_dir, name):
    return small_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _held_out(modulus):
    """crc32 of the id's text; ids of the remainder 2 are held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == 2, F.lit(False))


def op1_language_id(spark, sf_dir):
    from binledger.llm import language

    documents = _read(spark, sf_dir, "documents")
    names, matrix = language.train(documents.filter(~_held_out(4)))
    found = language.predict(documents.select("doc_id", "text"), names, matrix)
    return found.select("doc_id", _held_out(4).alias("held_out"), "lang_pred", "score")


def op2_ppm_scores(spark, sf_dir):
    from binledger.llm import ppm

    scores = ppm.ppm_scores(_read(spark, sf_dir, "documents"), ~_held_out(7))
    return scores.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op3_simhash_groups(spark, sf_dir):
    from binledger.llm import near

    return near.near_duplicates(_read(spark, sf_dir, "documents"))


def op4_surrogates(spark, sf_dir):
    from binledger.llm import surrogates

    # The secret of real runs is the caller's.
    documents = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace_entities(documents, secret="check")


def op5_tiled_leaks(spark, sf_dir):
    from binledger.llm import tiling

    return tiling.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op6_quality_rules(spark, sf_dir):
    from binledger.llm import rules

    found = rules.judged(_read(spark, sf_dir, "documents").select("doc_id", "text"), _read(spark, sf_dir, "labels"))
    return found.select("doc_id", *rules.STATISTICS, "base_failed", "kept")


def op7_jump_shards(spark, sf_dir):
    from binledger.llm import shards

    return shards.place_in_shards(_read(spark, sf_dir, "documents"), n=40).withColumn("law", F.lit("key"))


def op8_byte_bpe(spark, sf_dir):
    import public_tokenizers

    from binledger.llm import bpe

    codec = bpe.RankCodec.from_file(public_tokenizers.path(f"{TOKENIZERS}.tiktoken"), public_tokenizers.PATTERN)
    coded = bpe.decode_ids(bpe.encode_texts(_read(spark, sf_dir, "documents").select("doc_id", "text"), codec), codec)
    return coded.select(
        "doc_id",
        bpe.token_count().alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_token_files(spark, sf_dir):
    import public_tokenizers

    from binledger.llm import token_files

    with open(public_tokenizers.path(f"{TOKENIZERS}.json"), encoding="utf-8") as file:
        codec = token_files.LibraryCodec(file.read())
    tokens = token_files.document_tokens(_read(spark, sf_dir, "documents"), codec)
    return tokens.select("doc_id", "start", "n_tokens", "ids_crc32")


def op10_fuzzy_lines(spark, sf_dir):
    from binledger.llm import lines

    return lines.dedup_lines(_read(spark, sf_dir, "documents").select("doc_id", "text"), runs=True)


def op11_collocations(spark, sf_dir):
    from binledger.llm import stripes

    return stripes.collocations(_read(spark, sf_dir, "documents").select("lang", "text"))


def op12_aligned_tokens(spark, sf_dir):
    import public_tokenizers

    from binledger.llm import alignment

    with open(public_tokenizers.path(f"{TOKENIZERS}.json"), encoding="utf-8") as file:
        a = alignment.ByteLevelCodec(file.read())
    with open(public_tokenizers.path(f"{PIECES}.model"), "rb") as file:
        b = alignment.PieceModelCodec(file.read())
    aligned = alignment.align_tokens(_read(spark, sf_dir, "documents").select("doc_id", "text"), a, b)
    digest = F.when(F.col("n_groups") == 0, "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    aligned = staged(aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "links", digest), "aligned")
    pairs = alignment.possible_pairs(a.open().token_bytes, b.open().token_bytes)
    found = alignment.best_links(aligned, alignment.link_counts(aligned), pairs)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_license_scan(spark, sf_dir):
    from binledger.llm import licenses

    return licenses.scan_licenses(_read(spark, sf_dir, "documents").select("doc_id", "text"))


def queries():
    """One query per operator, and the pipeline."""
    return {name: fn for name, fn in globals().items() if name.startswith("op")}


_COLLOCATIONS = r"""
with pieces as (
  select doc_id, coalesce(lang, 'und') as lang, piece, regexp_extract_all(t, '[^\x20\x09]+') as w
  from (
    select doc_id, lang, unnest(parts) as t, generate_subscripts(parts, 1) as piece
    from (
      select doc_id, lang, regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]'
      ) as parts from documents
    ) a
  ) b
),
words as (select doc_id, lang, piece, unnest(w) as w1, unnest(range(len(w))) as i from pieces),
grams as (
  select lang, w1, lead(w1, 1) over pos as w2, lead(w1, 2) over pos as w3, lead(w1, 3) over pos as w4
  from words window pos as (partition by doc_id, piece order by i)
),
f as (
  select lang, [w1] as p, count(*) as f from grams group by all
  union all select lang, [w1, w2], count(*) from grams where w2 is not null group by all
  union all select lang, [w1, w2, w3], count(*) from grams where w3 is not null group by all
  union all select lang, [w1, w2, w3, w4], count(*) from grams where w4 is not null group by all
),
candidates as (select * from f where f >= 30 and len(p) > 1),
inner_parts as (
  select lang, p[i:i + n - 1] as p, f from (
    select *, unnest(range(1, len(p) - n + 2)) as i from (select *, unnest(range(2, len(p))) as n from candidates where len(p) > 2) x
  ) y
),
inside as (select lang, p, max(f) as longer from inner_parts group by all),
free as (
  select c.* from candidates c left join inside s on c.lang = s.lang and c.p = s.p
  where s.longer is null or 100 * s.longer < 80 * c.f
),
cuts as (select *, unnest(range(1, len(p))) as k from free),
scored as (
  select c.lang, c.p, c.f as a, c.k, x.f as l, y.f as r, cast(2000000::hugeint * c.f // (x.f + y.f) as bigint) as score
  from cuts c join f x on x.lang = c.lang and x.p = c.p[1:c.k] join f y on y.lang = c.lang and y.p = c.p[c.k + 1:]
),
best as (select * from scored qualify row_number() over (partition by lang, p order by score, k) = 1),
ranked as (
  select lang, array_to_string(p, ' ') as phrase, a, l, r, score,
         row_number() over (partition by lang order by score desc, a desc, encode(array_to_string(p, ' '))) as rank
  from best
)
select lang, rank, phrase, a, l, r, n, score
from ranked join (select lang, count(*) as n from words group by lang) t using (lang) where rank <= 2000
"""


def oracle_sql():
    from binledger.llm import licenses

    return {"op11_collocations": _COLLOCATIONS, "op13_license_scan": licenses.scan_sql()}
