"""JSON array files read by many tasks: records are found by byte range, whatever a file's size.

Spark's text reader cuts a file at every closing brace, and each split is read on its own. Whether a brace closes a
record depends on what comes before: how deep the nesting is and whether a string is open. So there are two passes.
The first works out for each split what it does to that state, for both cases (a string is open at its start or not);
put together in order these give every split's state at its start. The second cuts the splits into whole records and
the pieces of those that cross a border, which are then joined.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Splits of one read, whose states are broadcast (about 100 bytes each).
MAX_SPLITS = 1_000_000

_STRING = re.compile(r'"(?:[^"\\]|\\.)*"', re.DOTALL)
_STRING_END = re.compile(r'(?:[^"\\]|\\.)*"', re.DOTALL)
_EFFECT = "file string, block long, file_size long, bytes long, shape string, end0 boolean, depth0 int, end1 boolean, depth1 int"
_RECORD = "file string, block long, no int, kind string, text string"


def _pieces(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The texts between closing braces, in order within each split."""
    text = spark.read.option("lineSep", "}").text(paths)
    place = ("file_path", "file"), ("file_block_start", "block"), ("file_size", "file_size")
    return text.select("value", *(F.col(f"_metadata.{name}").alias(alias) for name, alias in place))


def _walk(piece: str, in_string: bool) -> tuple[bool, int]:
    """Whether a string is open after the piece, and how much deeper the nesting is."""
    if in_string:
        end = _STRING_END.match(piece)
        if not end:
            return True, 0
        piece = piece[end.end() :]
    outside = _STRING.sub("", piece)
    quote = outside.find('"')
    outside = outside if quote < 0 else outside[:quote]
    return quote >= 0, outside.count("{") + outside.count("[") - outside.count("]") - outside.count("}")


def _splits(batches: Iterator[pa.RecordBatch], *more: str) -> Iterator[tuple[tuple, str]]:
    """The pieces with what stands beside them: file, block, file_size and further columns."""
    for batch in batches:
        for row in zip(*(batch[c].to_pylist() for c in ("file", "block", "file_size", *more, "value")), strict=True):
            yield row[:-1], row[-1]


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: what it does to the state in either case, and how many bytes it has with all its braces."""
    place, now = None, None

    def given() -> pa.RecordBatch:
        row = dict(zip(("file", "block", "file_size"), place, strict=True)) | now
        return pa.RecordBatch.from_pylist([row], schema=_schema_of(_EFFECT))

    for where, piece in _splits(batches):
        if where != place:
            if place is not None:
                yield given()
            start = piece.lstrip("\ufeff \t\r\n")[:1] if where[1] == 0 else None
            place, now = where, {"bytes": 0, "shape": start, "end0": False, "depth0": 0, "end1": True, "depth1": 0}
        now["bytes"] += len(piece.encode("utf-8", "surrogatepass")) + 1
        for case in "01":
            is_open, deeper = _walk(piece, now[f"end{case}"])
            now[f"end{case}"] = is_open
            now[f"depth{case}"] += deeper - (not is_open)  # the brace that ended the piece
    if place is not None:
        yield given()


def _schema_of(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def _starts(effects: DataFrame) -> DataFrame:
    """(file, block, in_string, depth, base, open_end): each split's state at its start.

    ``base`` is the depth between records: 1 in an array, else 0. ``open_end``: the file's last piece, in this split,
    is not followed by a brace. A file has few splits, so its states are put together in one row.
    """
    split = F.struct("block", "end0", "depth0", "end1", "depth1")
    per_file = effects.groupBy("file").agg(
        F.sort_array(F.collect_list(split)).alias("splits"),
        F.max(F.col("shape") == "[").cast("int").alias("base"),
        # One byte too many, counted for a brace that is not there; the reader leaves out the three of a byte order mark.
        (F.sum("bytes") - F.max("file_size")).isin(1, -2).alias("open_end"),
        F.max("block").alias("last"),
    )
    state = "struct<in_string:boolean,depth:int,out:array<struct<block:bigint,in_string:boolean,depth:int>>>"
    begin = F.struct(F.lit(False).alias("in_string"), F.lit(0).alias("depth"), F.array().alias("out")).cast(state)

    def step(now, s):
        here = F.struct(s["block"].alias("block"), now["in_string"].alias("in_string"), now["depth"].alias("depth"))
        pick = lambda name: F.when(now["in_string"], s[f"{name}1"]).otherwise(s[f"{name}0"])
        return F.struct(
            pick("end").alias("in_string"),
            (now["depth"] + pick("depth")).alias("depth"),
            F.concat(now["out"], F.array(here)).alias("out"),
        ).cast(state)

    states = per_file.select("file", "base", "open_end", "last", F.explode(F.aggregate("splits", begin, step)["out"]).alias("s"))
    open_end = F.col("open_end") & (F.col("s.block") == F.col("last"))
    return states.select("file", "s.block", "s.in_string", "s.depth", F.coalesce("base", F.lit(0)).alias("base"), open_end.alias("open_end"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and pieces of records: kind ``whole``, or ``start``, ``middle``, ``end`` of one that crosses a border."""
    rows: list[dict] = []
    place, waiting, no = None, None, 0
    in_string, depth, parts, begun = False, 0, [], True

    def take(piece: str, closed: bool) -> None:
        nonlocal in_string, depth, no, begun
        in_string, deeper = _walk(piece, in_string)
        depth += deeper - (closed and not in_string)
        parts.append(piece + "}" * closed)
        if closed and not in_string and depth == place[5]:
            put("whole" if begun else "end")
            begun = True

    def put(kind: str) -> None:
        nonlocal no
        rows.append({"file": place[0], "block": place[1], "no": no, "kind": kind, "text": "".join(parts)})
        parts.clear()
        no += 1

    def finish() -> None:
        take(waiting, not place[6])
        if parts:
            put("start" if begun else "middle")

    for where, piece in _splits(batches, "in_string", "depth", "base", "open_end"):
        if where != place:
            if place is not None:
                finish()
            place, no, in_string, depth = where, 0, where[3], where[4]
            # The first split, or one that begins between two records.
            begun = where[1] == 0 or (not in_string and depth == where[5])
        else:
            take(waiting, True)
        waiting = piece
        if len(rows) >= 1000:
            yield pa.RecordBatch.from_pylist(rows, schema=_schema_of(_RECORD))
            rows.clear()
    if place is not None:
        finish()
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=_schema_of(_RECORD))


def array_records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, block, no, record): the texts of all records of JSON array files, in file order by block and no.

    Records are objects; what stands between them is left out. Files with one object, or with objects one after
    another, are read like arrays. A file that breaks off ends with a record that cannot be parsed. Each file is
    read twice.
    """
    pieces = _pieces(spark, paths)
    starts = _starts(pieces.mapInArrow(_effects, _EFFECT))
    many = starts.limit(MAX_SPLITS + 1).count()
    if many > MAX_SPLITS:
        raise ValueError(f"more than {MAX_SPLITS} splits: read fewer files at a time")
    # A broadcast join keeps the pieces where and as they were read.
    cut = pieces.join(F.broadcast(starts), ["file", "block"]).mapInArrow(_cut, _RECORD)
    whole = cut.filter("kind = 'whole'").select("file", "block", "no", "text")
    # At most two pieces a split.
    rank = F.when(F.col("kind") == "start", 1).otherwise(0)
    order = Window.partitionBy("file").orderBy("block", "no")
    crossing = cut.filter("kind <> 'whole'").withColumn("record_no", F.sum(rank).over(order))
    part = F.struct("block", "no", "text")
    joined = crossing.groupBy("file", "record_no").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    first = F.element_at("parts", 1)
    joined = joined.select("file", first["block"].alias("block"), first["no"].alias("no"), F.array_join("parts.text", "").alias("text"))
    record = F.regexp_replace("text", r"^[\x{FEFF}\s,\[\]]+|[\s,\]]+$", "").alias("record")
    return whole.unionByName(joined).select("file", "block", "no", record).filter("record <> ''")


def read_json_arrays(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """The records of JSON array files, and the texts (file, record) of those that are no JSON, for quarantine.

    A value of the wrong type becomes NULL, as in ``readers.read_raw_json``.
    """
    broken = "_broken"
    full = T.StructType([*schema.fields, T.StructField(broken, T.StringType())])
    parsed = array_records(spark, paths).select(
        "file", "record", F.from_json("record", full, {"columnNameOfCorruptRecord": broken}).alias("r")
    )
    # A wrong type also fills the corrupt column; only a text without any JSON value is quarantined.
    is_json = F.try_parse_json("record").isNotNull()
    return parsed.filter(is_json).select(*(F.col(f"r.{f.name}") for f in schema.fields)), parsed.filter(~is_json).select("file", "record")
