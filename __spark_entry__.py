"""
SQL that gives the same rows on the same tables."""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import binledger  # noqa: F401  (makes task functions travel by value)
from binledger.operators import catalog as C
from binledger.operators import checks, extract, headers, ledger, sample
from binledger.plans import table_files as tables
from binledger.plans.batch import choose_files
from binledger.plans.spread import size_ranges, spread
from binledger.schemas import CATALOG_COLUMNS, RESULT_SCHEMA
from binledger.sources.clustered import ClusteredLedger, drop_known_by_sketch
from binledger.sources.files import describe_files
from binledger.sources.folders import shared_folder
from binledger.sources.tables import BatchTable

# The operators for training data come with a subpackage that may be absent.
try:
    import corpus_pipeline
    from binledger.llm import entry as llm
except ImportError:
    corpus_pipeline = llm = None

GLOB = "/?/*.???"
BRACES = "/{0,1}/*[02468][!1-5].{exe,dl?}"
BUCKETS = 16
TASKS = 12
N = 100
SEED = 42


def _read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _catalog_and_log(spark, sf_dir):
    sources = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    return tables.document_catalog(*sources), tables.document_log(*sources)


def _catalog(spark, sf_dir):
    return tables.document_catalog(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def _globbed(spark, sf_dir):
    return C.glob_files(_catalog(spark, sf_dir), GLOB)


def _globbed_and_log(spark, sf_dir):
    catalog, log = _catalog_and_log(spark, sf_dir)
    return C.glob_files(catalog, GLOB), log


def _part_files(spark, sf_dir):
    return tables.part_files(_read(spark, sf_dir, "part"))


def _document_files(spark, sf_dir):
    return tables.document_files(_read(spark, sf_dir, "documents"))


def _clustered(spark, log, compacted=()):
    """The log's batches appended to a clustered ledger, one after the other; after those
    named a compaction."""
    done = ClusteredLedger(shared_folder(spark, "ledger"), buckets=BUCKETS, blocks=4)
    for batch in (1, 2):
        ledger.append_ledger(log.filter(F.col("batch") == batch), done, batch)
        if batch in compacted:
            done.compact(spark)
    return done


def q_catalog(spark, sf_dir):
    """From the URIs of the documents' files."""
    uri = F.concat(F.lit("s3a://bucket"), "path")
    return describe_files(_catalog(spark, sf_dir).drop("type", "class"), uri, "size")


def q_describe_files(spark, sf_dir):
    pages = _read(spark, sf_dir, "pages")
    return describe_files(pages, "url", F.octet_length("html"), class_value=0)


def q_glob_filter(spark, sf_dir):
    return _globbed(spark, sf_dir)


def q_glob_braces(spark, sf_dir):
    return C.glob_files(_catalog(spark, sf_dir), BRACES)


def q_path_parts(spark, sf_dir):
    pages = describe_files(_read(spark, sf_dir, "pages"), "url", F.octet_length("html"), class_value=0)
    return C.path_parts(C.union_files(_catalog(spark, sf_dir), pages).select("path"))


def q_balanced_sample(spark, sf_dir):
    return sample.balanced_sample(_globbed(spark, sf_dir), N, SEED, strict=False)


def q_balanced_sample_new(spark, sf_dir):
    """A sample of what is not recorded yet: later runs go on where earlier ended."""
    files, log = _globbed_and_log(spark, sf_dir)
    return sample.balanced_sample(ledger.drop_known_paths(files, log, "skip"), N, SEED, strict=False)


def q_balanced_sample_large(spark, sf_dir):
    """As many files of each class as there are toxic labels, from a catalogue in
    which class 1 partly occurs twice."""
    catalog = _catalog(spark, sf_dir)
    files = C.union_files(C.glob_files(catalog, GLOB), catalog.filter("class = 1"))
    n = 2 * _read(spark, sf_dir, "labels").filter("toxic = 1").count()
    return sample.balanced_sample(files, n, SEED, strict=True)


def q_distinct_files(spark, sf_dir):
    return C.distinct_files(tables.text_catalog(_read(spark, sf_dir, "documents")))


def q_union_files(spark, sf_dir):
    files = _catalog(spark, sf_dir)
    return C.union_files(files.filter("class = 0"), C.glob_files(files, GLOB)).select(CATALOG_COLUMNS)


def q_drop_processed(spark, sf_dir):
    return ledger.drop_processed(*_globbed_and_log(spark, sf_dir))


def q_drop_processed_nulls(spark, sf_dir):
    """Names by text, NULL sizes on both sides, many copies."""
    documents = _read(spark, sf_dir, "documents")
    done = tables.text_catalog(documents.filter("source < 'src2'"))
    return ledger.drop_processed(tables.text_catalog(documents), done)


def q_drop_processed_sample(spark, sf_dir):
    files, log = _globbed_and_log(spark, sf_dir)
    return ledger.drop_processed(sample.balanced_sample(files, N, SEED, strict=False), log, max_rows=N)


def q_drop_known_paths(spark, sf_dir):
    return ledger.drop_known_paths(*_globbed_and_log(spark, sf_dir), "skip")


def q_drop_known_paths_replace(spark, sf_dir):
    documents = _read(spark, sf_dir, "documents")
    done = tables.text_catalog(documents.filter("source < 'src2'"))
    return ledger.drop_known_paths(tables.text_catalog(documents), done, "replace")


def q_drop_known_paths_sketch(spark, sf_dir):
    files, log = _globbed_and_log(spark, sf_dir)
    return drop_known_by_sketch(files, _clustered(spark, log))


def q_drop_known_paths_sketch_replace(spark, sf_dir):
    """Bloom filters of a snapshot and of a later batch."""
    files, log = _globbed_and_log(spark, sf_dir)
    return drop_known_by_sketch(files, _clustered(spark, log, [1]), "replace")


def q_choose_from_clustered(spark, sf_dir):
    files, log = _globbed_and_log(spark, sf_dir)
    return choose_files(files, _clustered(spark, log), N, SEED, strict=False)


def q_compacted_ledger(spark, sf_dir):
    log = _catalog_and_log(spark, sf_dir)[1]
    return ledger.current_ledger(_clustered(spark, log, [1, 2]).read(spark))


def q_size_ranges(spark, sf_dir):
    return size_ranges(_globbed(spark, sf_dir), TASKS)


def q_stored_batches(spark, sf_dir):
    """The incremental batch appended twice, and the documents' files of another."""
    stored = BatchTable(shared_folder(spark, "results"))
    for batch, rows in ((1, q_incremental_batch), (2, q_extract_metadata), (1, q_incremental_batch)):
        stored.append_batch(rows(spark, sf_dir), batch)
    return stored.read(spark, RESULT_SCHEMA)


def q_current_ledger(spark, sf_dir):
    return ledger.current_ledger(_catalog_and_log(spark, sf_dir)[1])


def q_class_counts(spark, sf_dir):
    return C.class_counts(_catalog(spark, sf_dir))


def q_smallest_files(spark, sf_dir):
    return C.smallest_files(_catalog(spark, sf_dir), 50)


def q_header_columns(spark, sf_dir):
    return headers.header_columns(_part_files(spark, sf_dir)).drop("content")


def q_header_columns_lenient(spark, sf_dir):
    return headers.header_columns(_part_files(spark, sf_dir), strict_headers=False).drop("content")


def q_extract_metadata(spark, sf_dir):
    return extract.extract_metadata(_document_files(spark, sf_dir))


def q_extract_metadata_damaged(spark, sf_dir):
    return extract.extract_metadata(_part_files(spark, sf_dir))


def q_file_sections(spark, sf_dir):
    return extract.file_sections(_part_files(spark, sf_dir))


def q_sections_by_name(spark, sf_dir):
    return extract.sections_by_name(extract.file_sections(_part_files(spark, sf_dir)))


def q_file_imports(spark, sf_dir):
    return extract.file_imports(_document_files(spark, sf_dir))


def q_imports_by_file(spark, sf_dir):
    return extract.imports_by_file(extract.file_imports(_part_files(spark, sf_dir)))


def q_check_results(spark, sf_dir):
    """A batch of all documents, named after their texts, with every kind of
    violation, against a results table that holds those of some sources."""
    documents = _read(spark, sf_dir, "documents")
    long_name = F.when(F.col("lang") == "fr", F.repeat("source", 80)).otherwise(F.md5("text"))
    batch = documents.select(
        F.when(F.col("n_chars") > 25, F.concat(F.lit("/0/"), long_name, F.lit(".exe"))).alias("path"),
        F.when(F.col("lang") != "de", F.col("n_chars")).alias("size"),
        F.when(F.col("source") != "src7", F.concat(F.lit("e"), "lang")).alias("type"),
        F.when(F.col("lang") == "es", "16").when(F.col("lang") == "en", "64").alias("architecture"),
        F.lit(0).alias("imports"),
        F.lit(0).alias("exports"),
    ).withColumn("type", F.when(F.col("size") > 9000, "html5").otherwise(F.col("type")))
    stored = batch.filter("architecture = '64' and size > 2000")
    return checks.check_results(batch, stored)


def q_incremental_batch(spark, sf_dir):
    chosen = choose_files(*_globbed_and_log(spark, sf_dir), N, SEED, strict=False)
    return extract.extract_metadata(tables.catalog_contents(spread(chosen, N)))


def q_full_backlog(spark, sf_dir):
    """All files not recorded with their present size, with their metadata."""
    files, log = _globbed_and_log(spark, sf_dir)
    chosen = ledger.drop_processed(files, ledger.current_ledger(log))
    n = _read(spark, sf_dir, "documents").count()
    return extract.extract_metadata(tables.catalog_contents(spread(chosen, n)))


def entry(spark: SparkSession) -> DataFrame:
    """The incremental batch on the smallest tables."""
    return q_incremental_batch(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {name[2:]: fn for name, fn in globals().items() if name.startswith("q_")}
    return own | (llm.queries() | {"pipeline": corpus_pipeline.run} if llm else {})


_CATALOG = """
catalog as (
  select '/' || class || '/' || doc_id || '.' || type as path, n_chars as size, type, class, doc_id, lang, quality
  from (
    select d.doc_id, d.n_chars, d.lang, l.quality, coalesce(l.toxic, 0) as class,
           case when d.doc_id % 3 = 0 then 'dll' when d.doc_id % 3 = 1 then 'exe' else 'html5' end as type
    from documents d left join labels l on d.doc_id = l.doc_id
  ) t
),
globbed as (select * from catalog where regexp_matches(path, '^/[^/]/[^/]*[.][^/]{3}$')),
log as (
  select path, case when lang = 'en' then size else size + 1 end as size, type, 1 as batch
  from catalog where quality = 1
  union all
  select path, size, type, 2 as batch from catalog where quality = 1 and class = 1
),
current as (
  select path, size, type from (
    select *, row_number() over (partition by path order by batch desc, size desc, type desc) as version from log
  ) t where version = 1
),
picked as (
  select path, size, type, class from (
    select *, row_number() over (partition by class order by md5('42:' || path), path, size, type) as place from globbed
  ) t where place <= 50
)
"""

_TEXTS = """
texts as (
  select '/0/' || md5(text) || '.txt' as path, case when lang <> 'de' then n_chars end as size, 'txt' as type, source
  from documents
)
"""

_PARTS = """
shapes as (
  select p_partkey, p_size, p_name, p_partkey % 2 = 1 as wide, p_size % 10 <> 0 as importing,
         64 + 8 * (p_partkey % 300) as header, 1 + p_size % 5 as sections,
         case when p_size % 10 = 0 then 0 else 1 + p_size % 4 end as n_dlls,
         case when p_size % 10 = 0 then -1
              when p_partkey % 40 + p_size % 4 < 40 then (p_partkey + p_size % 4) % 40 else 39 end as longest
  from part
),
laid_out as (
  select *, case when wide then 8 else 4 end as width, case when wide then 112 else 96 end as fixed,
         p_size <> 49 as is_pe, '/0/' || p_partkey || '.exe' as path,
         header + 152 + case when wide then 112 else 96 end + 40 * sections as start,
         40 + 20 * (n_dlls + 1) + n_dlls * (longest + 1) * case when wide then 8 else 4 end as payload
  from shapes
),
parts as (
  select *, start + payload as exe_size,
         1024 * cast(ceil((header + 24 + case when wide and p_size <> 50 then 112 else 96 end) / 1024.0) as int) as read,
         case when p_size % 7 = 0 then 4096 else 512 end as claimed
  from laid_out
),
judged as (
  select *, not is_pe or p_size = 50 or claimed > read as corrupted,
         case when wide then '64' else '32' end as bits,
         case when not is_pe then null when p_size = 50 and wide then 0 else 2 end as n_directories
  from parts
)
"""

_DLLS = """
dlls as (
  select path, corrupted, i as dll_idx, (p_partkey + i) % 40 as n_symbols
  from judged, range(0, 4) r(i) where i < n_dlls
)
"""


_HEADERS = """
select path, cast(case when is_pe then exe_size else octet_length(encode(p_name)) end as bigint) as size, 'exe' as type,
       is_pe, cast(case when is_pe then read else 2048 end as int) as headers_read,
       cast(case when is_pe then claimed end as bigint) as size_of_headers, corrupted,
       case when not corrupted then bits end as architecture,
       cast(case when is_pe then sections end as int) as n_sections,
       cast(case when is_pe then header + 24 + fixed + 128 end as bigint) as section_offset,
       cast(n_directories as int) as n_directories,
       cast(case when n_directories = 2 then case when p_size > 1 then 1048576 else 0 end end as bigint) as export_rva,
       cast(case when n_directories = 2 then case when p_size > 1 then 40 else 0 end end as bigint) as export_size,
       cast(case when n_directories = 2 then case when importing then 1048616 else 0 end end as bigint) as import_rva,
       cast(case when n_directories = 2 then case when importing then 20 * (n_dlls + 1) else 0 end end as bigint)
         as import_size,
       coalesce(n_directories = 2 and p_size > 1, false) as has_exports,
       coalesce(n_directories = 2 and importing, false) as has_imports
from judged"""


def _with(*parts, select):
    return "with " + ",".join(parts) + select


def oracle_sql() -> dict[str, str]:
    picked_new = "(select path, size, type from picked except select path, size, type from {done})"
    metadata = """
select path, size, type, case when size % 2 = 1 then '64' else '32' end as architecture,
       cast(size % 5 + size % 7 + cast(regexp_extract(path, '/([0-9]+)[.]', 1) as bigint) % 37 as bigint) as imports,
       cast(size % 11 as bigint) as exports
from {chosen} t"""
    page_paths = "select regexp_extract(url, '^[a-z]+://[^/]*([^?#]*)', 1) as path, html from pages"
    page_files = f"""
select path, octet_length(encode(html)) as size, regexp_extract(path, '([^/.]*)$', 1) as type, 0 as class
from ({page_paths}) t"""
    own = {
        "catalog": _with(_CATALOG, select="select path, size, type, class from catalog"),
        "describe_files": page_files,
        "glob_filter": _with(_CATALOG, select="select path, size, type, class from globbed"),
        "glob_braces": _with(
            _CATALOG,
            select="""
select path, size, type, class from catalog
where regexp_matches(path, '^/[01]/[^/]*[02468][^1-5/][.](exe|dl[^/])$')""",
        ),
        "path_parts": _with(
            _CATALOG,
            select=f"""
select path, case when dir <> '/' then rtrim(dir, '/') else dir end as dir,
       case when base like '_%.%' then regexp_extract(base, '^(.*)[.][^.]*$', 1) else base end as name,
       case when base like '_%.%' then regexp_extract(base, '[.]([^.]*)$', 1) else '' end as extension
from (
  select path, regexp_extract(path, '^(.*/)[^/]*$', 1) as dir, regexp_extract(path, '([^/]*)$', 1) as base
  from (select path from catalog union all select path from ({page_paths}) u) v
) t""",
        ),
        "balanced_sample": _with(_CATALOG, select="select path, size, type, class from picked"),
        "balanced_sample_large": _with(
            _CATALOG,
            """
files as (
  select path, size, type, class from globbed union all
  select path, size, type, class from catalog where class = 1
)""",
            select="""
select path, size, type, class from (
  select *, row_number() over (partition by class order by md5('42:' || path), path, size, type) as place from files
) t where place <= (select count(*) from labels where toxic = 1)""",
        ),
        "distinct_files": _with(_TEXTS, select="select distinct path, size, type from texts"),
        "union_files": _with(
            _CATALOG,
            select="""
select path, size, type from catalog where class = 0 union all select path, size, type from globbed""",
        ),
        "drop_processed": _with(
            _CATALOG, select="select path, size, type from globbed except select path, size, type from log"
        ),
        "drop_processed_nulls": _with(
            _TEXTS,
            select="""
select path, size, type from texts except select path, size, type from texts where source < 'src2'""",
        ),
        "drop_processed_sample": _with(
            _CATALOG, select="select path, size, type from picked except select path, size, type from log"
        ),
        "drop_known_paths": _with(
            _CATALOG,
            select="""
select path, size, type, class from globbed g where not exists (select 1 from log l where l.path = g.path)""",
        ),
        "drop_known_paths_replace": _with(
            _TEXTS,
            select="""
select path, size, type from texts t where not exists (
  select 1 from texts l where l.source < 'src2' and l.path is not distinct from t.path
    and l.size is not distinct from t.size and l.type is not distinct from t.type)""",
        ),
        "drop_known_paths_sketch": _with(
            _CATALOG,
            select="""
select path, size, type, class from globbed g where not exists (select 1 from log l where l.path = g.path)""",
        ),
        "drop_known_paths_sketch_replace": _with(
            _CATALOG,
            """
kept as (
  select path, size, type from (
    select *, row_number() over (partition by path order by batch desc, size desc, type desc) as version from log where batch = 1
  ) t where version = 1
  union all select path, size, type from log where batch = 2
)""",
            select="""
select path, size, type, class from globbed g where not exists (
  select 1 from kept l where l.path = g.path and l.size = g.size and l.type = g.type)""",
        ),
        "choose_from_clustered": _with(
            _CATALOG, select="select path, size, type from picked except select path, size, type from current"
        ),
        "compacted_ledger": _with(_CATALOG, select="select path, size, type from current"),
        "size_ranges": _with(
            _CATALOG,
            """
weighed as (select *, substr(md5(path), 1, 3) as lane, size + 4096 as bytes from globbed)""",
            select=f"""
select path, size, type, class,
       cast((sum(bytes) over (order by lane, path, size, type) - bytes) * {TASKS} // (select sum(bytes) from weighed) as int) as task
from weighed""",
        ),
        "current_ledger": _with(_CATALOG, select="select path, size, type from current"),
        "class_counts": _with(
            _CATALOG,
            select="""
select class, type, count(*) as files, cast(sum(size) as bigint) as bytes from catalog group by class, type""",
        ),
        "smallest_files": _with(
            _CATALOG, select="select path, size, type, class from catalog order by size, path, type limit 50"
        ),
        "header_columns": _with(_PARTS, select=_HEADERS),
        "header_columns_lenient": _with(
            _PARTS, "lenient as (select * exclude (corrupted), not is_pe or p_size = 50 as corrupted from judged)",
            select=_HEADERS.replace("from judged", "from lenient"),
        ),
        "balanced_sample_new": _with(
            _CATALOG,
            select="""
select path, size, type, class from (
  select *, row_number() over (partition by class order by md5('42:' || path), path, size, type) as place
  from globbed g where not exists (select 1 from log l where l.path = g.path)
) t where place <= 50""",
        ),
        "extract_metadata": """
select path, cast(case when lang = 'fr' then bytes else head + payload + bytes end as bigint) as size, 'exe' as type,
       case when lang = 'fr' then null when wide then '64' else '32' end as architecture,
       cast(case when lang = 'fr' then -1 else imports end as bigint) as imports,
       cast(case when lang = 'fr' then -1 else n_chars % 13 end as bigint) as exports
from (
  select *, 40 + 20 * (n + 1) + n * (longest + 1) * case when wide then 8 else 4 end as payload
  from (
    select '/0/' || doc_id || '.exe' as path, lang, n_chars, octet_length(encode(text)) as bytes, lang = 'en' as wide,
           320 + case when lang = 'en' then 112 else 96 end as head,
           n_chars % 4 + 1 as n,
           list_sum([(doc_id + i) % 50 for i in range(0, n_chars % 4 + 1)]) as imports,
           list_max([(doc_id + i) % 50 for i in range(0, n_chars % 4 + 1)]) as longest
    from documents
  ) t
) u""",
        "extract_metadata_damaged": _with(
            _PARTS,
            select="""
select path, cast(case when is_pe then exe_size else octet_length(encode(p_name)) end as bigint) as size, 'exe' as type,
       case when not corrupted then bits end as architecture,
       cast(case when corrupted then -1
            else coalesce(list_sum([(p_partkey + i) % 40 for i in range(0, n_dlls)]), 0) end as bigint) as imports,
       cast(case when corrupted then -1 else p_size - 1 end as bigint) as exports
from judged""",
        ),
        "file_sections": _with(
            _PARTS,
            select="""
select path, cast(i as int) as idx,
       case when i = sections - 1 then '.idata' when i % 2 = 0 then '.text' else '.rsrc' end as name,
       cast(case when i = sections - 1 then 1048576 else 4096 * (i + 1) end as bigint) as va,
       cast(case when i = sections - 1 then payload else 16 * (i + 1) end as bigint) as raw_size,
       cast(start as bigint) as raw_ptr, cast(8 * i * (i + 1) as bigint) as raw_offset_sum
from judged, range(0, 5) r(i) where i < sections and not corrupted""",
        ),
        "sections_by_name": _with(
            _PARTS,
            select="""
select path, name, cast(max(i) as int) as idx from (
  select path, i, case when i = sections - 1 then '.idata' when i % 2 = 0 then '.text' else '.rsrc' end as name
  from judged, range(0, 5) r(i) where i < sections and not corrupted
) t group by path, name""",
        ),
        "file_imports": """
select '/0/' || doc_id || '.exe' as path, cast(i as int) as dll_idx, cast((doc_id + i) % 50 as int) as n_symbols
from documents, range(0, 4) r(i) where i <= n_chars % 4 and lang <> 'fr'""",
        "imports_by_file": _with(
            _PARTS,
            _DLLS,
            select="""
select path, count(*) as n_dlls, cast(sum(n_symbols) as bigint) as imports
from dlls where not corrupted group by path""",
        ),
        "check_results": """
with batch as (
  select case when n_chars > 25 then '/0/' || case when lang = 'fr' then repeat(source, 80) else md5(text) end || '.exe'
         end as path,
         case when lang <> 'de' then n_chars end as size,
         case when lang <> 'de' and n_chars > 9000 then 'html5' when source <> 'src7' then 'e' || lang end as type,
         case when lang = 'es' then '16' when lang = 'en' then '64' end as architecture
  from documents
),
broken as (
  select path, 'path_missing' as rule from batch where path is null union all
  select path, 'path_too_long' from batch where length(path) > 255 union all
  select path, 'size_missing' from batch where size is null union all
  select path, 'type_missing' from batch where type is null union all
  select path, 'type_too_long' from batch where length(type) > 3 union all
  select path, 'architecture_unknown' from batch where architecture not in ('32', '64') union all
  select path, 'path_repeated' from batch where path in (select path from batch group by path having count(*) > 1)
  union all
  select path, 'path_stored_already' from batch
  where path in (select path from batch where architecture = '64' and size > 2000)
)
select path, rule, count(*) as n_rows from broken group by path, rule""",
        "incremental_batch": _with(_CATALOG, select=metadata.format(chosen=picked_new.format(done="current"))),
        "full_backlog": _with(
            _CATALOG,
            select=metadata.format(
                chosen="(select path, size, type from globbed except select path, size, type from current)"
            ),
        ),
    }
    own["stored_batches"] = f"select * from ({own['incremental_batch']}) a union all select * from ({own['extract_metadata']}) b"
    if llm:
        own |= llm.oracle_sql() | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
    return own
