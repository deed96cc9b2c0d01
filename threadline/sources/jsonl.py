"""JSONL conversation sources.

The interchange line is ``{"conversations": [{"from": .., "value": ..}, ..]}``
plus any other top-level fields.  Lines are read with the text source, so bad
bytes, blank lines and malformed JSON can be handled per line instead of
failing or silently vanishing:

* :func:`scan_jsonl` (tolerant) - invalid UTF-8 is replaced, blank and
  malformed lines are skipped, lines whose ``conversations`` is missing or
  empty are skipped;
* :func:`scan_jsonl_strict` - blank lines are skipped, any other malformed
  line fails the job.

A line is valid when it is exactly one JSON value, as a strict JSON reader
sees it (no single quotes, nothing after the value).  ``conv_id`` is kept as
text, entries of ``conversations`` that are no objects are skipped, ``start`` and
``variant`` are read back for records that were written in segments, and all
other top-level fields ride along in ``extra`` (a map of their JSON texts).

Each record keeps its file order as ``(src_file, src_block, src_seq)``:
a split's block offset and a within-split sequence number.  The order of
these keys is the file order whatever the split size, so an exact dense id
can be derived later with :func:`number_records`; lines without ``conv_id`` get
one from it with :func:`with_record_ids`.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable
from fnmatch import fnmatch

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from threadline.functions import roles as R
from threadline.functions import text as T
from threadline.operators.positions import global_positions
from threadline.session import ensure_checkpoint_dir

log = logging.getLogger(__name__)

TURN_STRUCT = Ty.StructType([Ty.StructField("from", Ty.StringType()), Ty.StructField("value", Ty.StringType())])
LINE_SCHEMA = Ty.StructType([
    Ty.StructField("conv_id", Ty.StringType()),
    Ty.StructField("conversations", Ty.ArrayType(TURN_STRUCT)),
])
# Pattern of files to read: what the sinks write (``part-*.json``) and ``.jsonl`` files.
DEFAULT_GLOB = "*.json*"
# Fields of a line that become columns of their own.
KNOWN_FIELDS = ("conv_id", "conversations", "start", "variant")
ORDER_COLS = ["src_file", "src_block", "src_seq"]
# Fixed value: path fragment skipped unless explicitly included.
SUBAGENT_FRAGMENT = "subagents"


def existing_paths(spark: SparkSession, paths: Iterable[str], glob: str | None = None) -> list[str]:
    """Resolve glob paths and keep those that exist (listing only, on the driver).

    Warns about a path that does not exist, and about one below which no file
    matches ``glob``, so that an empty read is never silent.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for p in paths:
        jp = jvm.org.apache.hadoop.fs.Path(p)
        fs = jp.getFileSystem(conf)
        hits = [h.getPath() for h in (fs.globStatus(jp) or [])]
        if not hits:
            log.warning("file not found, skipped: %s", p)
            continue
        found += [h.toString() for h in hits]
        if not any(_has_file(fs, h, glob) for h in hits):
            log.warning("no file below %s matches %s: nothing is read from it", p, glob or "*")
    return found


def _has_file(fs, path, glob: str | None) -> bool:
    """A file below ``path`` whose name matches ``glob`` and is no hidden one (stops at the first)."""
    files = fs.listFiles(path, True)
    while files.hasNext():
        name = files.next().getPath().getName()
        if not name.startswith(("_", ".")) and (glob is None or fnmatch(name, glob)):
            return True
    return False


def read_lines(spark: SparkSession, paths, recursive: bool = False, glob: str | None = None,
               exclude_fragment: str | None = None) -> DataFrame:
    """Raw lines with their file-order key; excluded paths are pruned at listing."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.format("text")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(paths)
    if exclude_fragment:
        df = df.filter(~F.col("_metadata.file_path").contains(exclude_fragment))
    # partition columns discovered from folder names (e.g. split=train/) ride along
    discovered = [c for c in df.columns if c != "value"]
    return df.select(
        F.make_valid_utf8("value").alias("line"),
        F.col("_metadata.file_path").alias("src_file"),
        F.col("_metadata.file_block_start").alias("src_block"),
        F.monotonically_increasing_id().alias("src_seq"),
        *discovered)


def _extras(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in ("line", "rec", *ORDER_COLS)]


def _fields(body) -> Column:
    """Top-level fields of a line as a map of their JSON texts; null unless the line is one JSON object.

    The line is parsed inside brackets: content after the value would make the list longer or the
    brackets unbalanced.  Only a line with a ``]`` before a ``[`` or ``,`` could close them
    early; it must also parse as the value of a field.
    """
    listed = F.from_json(F.concat(F.lit("["), body, F.lit("]")), "array<map<string,string>>",
                         {"allowSingleQuotes": "false"})
    whole = ~body.rlike(r"\]\s*[\[,]") | T._parses(body)
    return F.when((F.size(listed) == 1) & whole, listed[0])


def _turns(fields) -> Column:
    """The objects of a line's ``conversations`` list as ``ARRAY<STRUCT<from, value>>``."""
    entries = F.from_json(fields["conversations"], "array<string>")
    objects = F.filter(entries, lambda e: F.coalesce(e.startswith("{"), F.lit(False)))
    return F.transform(objects, lambda e: F.from_json(e, TURN_STRUCT))


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with ``value`` as a column that later expressions read but never repeat.

    A one-element explode: neither projects above it nor filters pushed down are merged with it.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def parse_lines(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """``lines`` without ``line_col`` and with ``body`` (the trimmed line) and ``rec``: a struct of ``valid``
    (exactly one JSON value of any kind), ``conv``, ``conv_id``, ``start``, ``variant``, ``extra``.

    The line is parsed once, as the list ``[line, "md5 of line"]``: content after the value either breaks the list
    or moves the md5 from second place, and no line holds its own md5.  All fields come from that one variant.
    Lines that no variant can hold (repeated keys, ``NaN``, malformed ones) are read again as text.
    """
    df = _once(lines, "body", T.trim_ws(line_col)).drop(line_col)
    df = _once(df, "_seal", F.md5("body"))
    df = _once(df, "_v", F.try_parse_json(F.concat(F.lit("["), F.col("body"), F.lit(',"'), F.col("_seal"), F.lit('"]'))))
    df = _once(df, "_j", F.when(F.col("_v").isNull(), _fields(F.col("body"))))
    v, j = F.col("_v"), F.col("_j")

    def record(valid, conv, conv_id, start, variant, extra):
        return F.struct(valid.alias("valid"), conv.alias("conv"), conv_id.alias("conv_id"), start.try_cast("bigint").alias("start"),
                        variant.try_cast("int").alias("variant"), extra.alias("extra"))

    entries = F.filter(F.try_variant_get(v, "$[0].conversations", "array<variant>"),
                       lambda e: F.coalesce(F.schema_of_variant(e).startswith("OBJECT"), F.lit(False)))
    others = F.map_filter(F.try_variant_get(v, "$[0]", "map<string,variant>"), lambda k, _: ~k.isin(*KNOWN_FIELDS))
    once = record(F.lit(True), F.transform(entries, lambda e: F.struct(
        F.try_variant_get(e, "$.from", "string").alias("from"), F.try_variant_get(e, "$.value", "string").alias("value"))),
        *(F.try_variant_get(v, f"$[0].{f}", "string") for f in ("conv_id", "start", "variant")),
        F.transform_values(others, lambda _, x: F.try_variant_get(x, "$", "string")))
    again = record(F.coalesce(F.when(F.col("body").startswith("{"), j.isNotNull()).otherwise(T._parses(F.col("body"))), F.lit(False)),
                   _turns(j), j["conv_id"], j["start"], j["variant"], F.map_filter(j, lambda k, _: ~k.isin(*KNOWN_FIELDS)))
    none = F.lit(None).cast("string")
    bad = record(F.lit(False), F.lit(None).cast(Ty.ArrayType(TURN_STRUCT)), none, none, none, F.lit(None).cast("map<string,string>"))
    sealed = F.try_variant_get(v, "$[1]", "string") == F.col("_seal")
    return _once(df, "rec", F.when(v.isNull(), again).when(sealed, once).otherwise(bad)).drop("_seal", "_v", "_j")


def _parse(lines: DataFrame, strict: bool) -> DataFrame:
    parsed = parse_lines(lines.filter(T.is_nonblank("line")))
    if strict:
        refused = F.raise_error(F.concat(F.lit("malformed line: "), F.substring("body", 1, 200)))
        parsed = parsed.withColumn("rec", F.when(F.col("rec.valid"), F.col("rec")).otherwise(
            refused.cast(parsed.schema["rec"].dataType)))
    return parsed.drop("body")


def with_outcome(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """``lines`` with ``outcome``, what becomes of each: blank / malformed / no_records / kept."""
    parsed = parse_lines(lines.withColumn("_line", F.col(line_col)), "_line")
    return parsed.withColumn("outcome", F.when(F.length("body") == 0, F.lit("blank"))
                             .when(~F.col("rec.valid"), F.lit("malformed"))
                             .when(F.coalesce(F.size("rec.conv") > 0, F.lit(False)), F.lit("kept"))
                             .otherwise(F.lit("no_records"))).drop("body", "rec")


def classify_lines(lines: DataFrame) -> DataFrame:
    """Outcome per line: blank / malformed / no_records / kept (reject counters)."""
    return with_outcome(lines).select(*ORDER_COLS, "outcome")


def _records(parsed: DataFrame) -> DataFrame:
    taken = _extras(parsed)
    turns = F.transform("rec.conv", lambda t, i: F.struct(
        (i + F.col("start")).cast("bigint").alias("pos"), (i + F.col("start")).cast("bigint").alias("turn"),
        R.from_interchange_role(t["from"]).alias("role"), t["value"].alias("text")))
    return (parsed.filter(F.coalesce(F.size("rec.conv") > 0, F.lit(False)))
            .select(*ORDER_COLS, "rec", F.coalesce("rec.start", F.lit(0).cast("bigint")).alias("start"), *taken)
            .select(*ORDER_COLS, "rec.conv_id", "start", "rec.variant", turns.alias("turns"), "rec.extra", *taken))


def scan_lines(lines: DataFrame) -> DataFrame:
    """Tolerant scan of raw lines (:func:`read_lines`)."""
    return _records(_parse(lines, strict=False))


def scan_jsonl(spark: SparkSession, paths, recursive: bool = False, glob: str | None = DEFAULT_GLOB,
               exclude_fragment: str | None = None, check_missing: bool = True) -> DataFrame:
    """Tolerant scan -> records ``(src_file, src_block, src_seq, conv_id, start, variant, turns, extra)``.

    ``paths`` may hold folders, files and globs; missing ones are skipped with a
    warning (several input files may be given), and a path that yields no file is warned about.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if check_missing:
        paths = existing_paths(spark, paths, glob)
    if not paths:
        return spark.createDataFrame([], _records_schema())
    return scan_lines(read_lines(spark, paths, recursive, glob, exclude_fragment))


def scan_jsonl_strict(spark: SparkSession, paths, glob: str | None = DEFAULT_GLOB, keep_line: bool = False) -> DataFrame:
    """Strict scan: blank lines skipped, a malformed line fails the job."""
    lines = read_lines(spark, paths, False, glob)
    if keep_line:
        return _records(_parse(lines.withColumn("_line", F.col("line")), strict=True)).withColumnRenamed("_line", "line")
    return _records(_parse(lines, strict=True))


def scan_recursive(spark: SparkSession, root: str, include_subagents: bool = False) -> DataFrame:
    """All JSONL files below ``root``; paths containing the sub-agent fragment are skipped unless included."""
    return scan_jsonl(spark, root, recursive=True, exclude_fragment=None if include_subagents else SUBAGENT_FRAGMENT)


def concat(*frames: DataFrame) -> DataFrame:
    """Concatenate datasets (``cat a b > c``): union by name, missing columns as null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


#: A table of file splits of at most so many rows is broadcast (about 100 bytes each); a longer one is shuffled.
BLOCK_ROWS = 1_000_000
GROUP_FILES = 4096


def number_records(records: DataFrame, id_col: str = "rec_id", with_total: bool = False):
    """Add ``id_col``: the record's exact 0-based position in file order.

    Records lie in file order inside their file splits, so a record's number is the number of records in
    the splits before its own (a prefix sum over a table with one row per file split: inside a
    file, then over files) plus its place in the split.  Records are not moved.  With
    ``with_total=True`` also returns the record count.
    """
    block = ["src_file", "src_block"]
    # rows are numbered where they are; a split's rows are neighbours
    placed = records.withColumn("_tl_at", F.monotonically_increasing_id())
    counts = placed.groupBy(*block).agg(F.count(F.lit(1)).alias("_tl_n"), F.min("_tl_at").alias("_tl_first"))
    ensure_checkpoint_dir(records.sparkSession)
    counts = counts.checkpoint()
    files = counts.groupBy("src_file").agg(F.sum("_tl_n").alias("_tl_n"))
    ranked = global_positions(files, ["src_file"], pos_col="_tl_f").frame
    # files in groups of GROUP_FILES: sums inside a group, then over groups
    group = F.floor(F.col("_tl_f") / GROUP_FILES)
    zero = F.lit(0).cast("bigint")
    grouped = ranked.withColumn("_tl_g", group)
    sums = sorted((r[0], r[1]) for r in grouped.groupBy("_tl_g").agg(F.sum("_tl_n")).collect())
    bases, base = F.lit(0).cast("bigint"), 0
    table = {}
    for g, n in sums:
        table[g] = base
        base += n
    if len(table) > 1:
        bases = F.element_at(F.create_map(*[F.lit(x).cast("bigint") for kv in table.items() for x in kv]), F.col("_tl_g"))
    in_group = F.coalesce(F.sum("_tl_n").over(Window.partitionBy("_tl_g").orderBy("_tl_f").rowsBetween(Window.unboundedPreceding, -1)), zero)
    files = grouped.select("src_file", (bases + in_group).alias("_tl_file"))
    in_file = F.coalesce(F.sum("_tl_n").over(Window.partitionBy("src_file").orderBy("src_block").rowsBetween(Window.unboundedPreceding, -1)), zero)
    blocks = (counts.withColumn("_tl_block", in_file).join(files, "src_file")
              .select(*block, (F.col("_tl_file") + F.col("_tl_block") - F.col("_tl_first")).alias("_tl_shift")).checkpoint())
    if blocks.count() <= BLOCK_ROWS:
        blocks = F.broadcast(blocks)
    frame = placed.join(blocks, block).withColumn(id_col, F.col("_tl_at") + F.col("_tl_shift")).select(*records.columns, id_col)
    return (frame, base) if with_total else frame


def with_record_ids(records: DataFrame, id_col: str = "conv_id", always: bool = False) -> DataFrame:
    """Records with an identity each: a null ``id_col`` becomes ``line-<number in file order>``, zero-padded so that ids sort in file order.

    The interchange line of other tools has no id; without one, records would share a null key in splits, documents and
    dedup.  ``always`` numbers records that have an id too (sources whose ids repeat).
    """
    numbered = number_records(records, "_tl_number")
    made = F.concat(F.lit("line-"), F.lpad(F.col("_tl_number").cast("string"), 15, "0"))
    out = made if always else F.coalesce(F.col(id_col).cast("string"), made)
    return numbered.withColumn(id_col, out).select(*records.columns)


def flatten_records(records: DataFrame, keys=("conv_id", "start")) -> DataFrame:
    """Records -> flat turns ``(keys.., pos, turn, role, text)``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return records.select(*keys, F.explode("turns").alias("t")).select(*keys, "t.*")


def _records_schema() -> Ty.StructType:
    turn = Ty.StructType([Ty.StructField("pos", Ty.LongType()), Ty.StructField("turn", Ty.LongType()),
                          Ty.StructField("role", Ty.StringType()), Ty.StructField("text", Ty.StringType())])
    return Ty.StructType([
        Ty.StructField("src_file", Ty.StringType()), Ty.StructField("src_block", Ty.LongType()),
        Ty.StructField("src_seq", Ty.LongType()), Ty.StructField("conv_id", Ty.StringType()),
        Ty.StructField("start", Ty.LongType()), Ty.StructField("variant", Ty.IntegerType()),
        Ty.StructField("turns", Ty.ArrayType(turn)),
        Ty.StructField("extra", Ty.MapType(Ty.StringType(), Ty.StringType())),
    ])
