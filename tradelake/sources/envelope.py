"""Records of large response envelopes, read by byte range (S3).

An envelope is one JSON object with its records in a list under a key.  Spark's
text source reads a file in splits, here with ``}`` as the line separator, so a
row is the text up to the next closing brace, wherever a split starts.

1. *Summaries.*  What a split means depends on where it starts: outside a
   string or inside one, and how deep.  A task goes through its splits once
   under both assumptions and notes for each whether the quotes leave the split
   inside a string, how the depth changes, and for every depth the last bracket
   that opened there: is it the record list?
2. *Starts.*  Running sums over a file's splits, a short row each, give every
   split its true start: in a string or not, its depth, in the record list or not.
3. *Records.*  With its start a split knows its record ends.  Whole records
   leave the task that read them; what lies before the first and behind the last
   end in a split is joined with that of its neighbours.
4. *Parsing.*  Each record is parsed by itself with the declared schema.

Nothing broken passes as data: a record that does not parse, anything but
``null`` between records, and a file that ends early or does not end at depth 0
come out as rows with their text in ``_corrupt_record``.

A file is read twice and never moved as a whole: the starts are joined by
broadcast up to ``BROADCAST_SPLITS`` splits (some 20 MB), beyond that by a
shuffle of the chunks.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from ..session import checkpoint_root

BROADCAST_SPLITS = 200_000
_QUOTE, _BACKSLASH = ord('"'), ord("\\")
_STEP = np.zeros(256, dtype=np.int8)
_STEP[[ord("{"), ord("[")]] = 1
_STEP[[ord("}"), ord("]")]] = -1
#: Depths of the envelope, of its record list and of a record's inside.
LIST, RECORD = 2, 3


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """(f, g, size, text): what stands before each closing brace, by file and split."""
    return spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("g"),
        F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("text"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, bool]]:
    """(rows, bytes with their closing braces, whether a new split begins) of
    stretches of one split."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        f, g = np.asarray(batch.column("f").dictionary_encode().indices), np.asarray(batch.column("g"))
        cuts = np.flatnonzero((f[1:] != f[:-1]) | (g[1:] != g[:-1])) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(f)]):
            rows = batch.slice(lo, hi - lo)
            data = b"}".join([*rows.column("text").to_pylist(), b""])
            here = (rows.column("f")[0].as_py(), int(g[lo]))
            yield rows, np.frombuffer(data, dtype=np.uint8), here != last
            last = here


def _quotes(data: np.ndarray) -> np.ndarray:
    """How many quotes that are not escaped stand before each byte, and in all."""
    at = np.flatnonzero(data == _QUOTE)
    plain = np.maximum.accumulate(np.where(data != _BACKSLASH, np.arange(len(data)), -1))
    slashes = np.where(at > 0, at - 1 - plain[at - 1], 0)
    real = np.zeros(len(data) + 1, dtype=np.int32)
    real[at[slashes % 2 == 0] + 1] = 1
    return np.cumsum(real)


def _outside(data: np.ndarray, quotes: np.ndarray, inside: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and steps of the brackets outside strings."""
    step = _STEP[data]
    at = np.flatnonzero((step != 0) & ((quotes[:-1] + inside) % 2 == 0))
    return at, step[at]


def _opens_list(data: bytes, at: int, key: bytes) -> bool:
    """Is the bracket at ``at`` the list under ``key``?"""
    if data[at] != ord("["):
        return False
    head = data[max(0, at - len(key) - 64):at].rstrip()
    if not head.endswith(b":"):
        head = data[:at].rstrip()    # a great many blanks
    head = head[:-1].rstrip() if head.endswith(b":") else b""
    return head.endswith(key) and not head.endswith(b"\\" + key)


def _summaries(rows: DataFrame, key: bytes) -> DataFrame:
    """(f, g, size, bytes, quotes, steps, lists) per split: for a start outside
    and inside a string, the change of depth and by relative depth whether the
    last bracket opened there was the list."""
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict | None = None

        def out() -> Iterator[pa.RecordBatch]:
            if held:
                yield pa.RecordBatch.from_pydict(
                    {k: [held[k]] for k in ("f", "g", "size", "bytes", "quotes", "steps", "blank")}
                    | {"lists": [[list(x.items()) for x in held["lists"]]]}, schema=schema)

        for part, data, new in _runs(batches):
            if new:
                yield from out()
                held = {k: part.column(k)[0].as_py() for k in ("f", "g", "size")} | {
                    "bytes": 0, "quotes": 0, "steps": [0, 0], "lists": [{}, {}], "blank": False}
            quotes, text = _quotes(data), data.tobytes()
            for start in (0, 1):
                at, step = _outside(data, quotes, (held["quotes"] + start) % 2)
                depth = held["steps"][start] + np.cumsum(step, dtype=np.int64)
                opened = np.flatnonzero(step > 0)[::-1]
                levels, first = np.unique(depth[opened] - 1, return_index=True)   # the last at each level
                for level, i in zip(levels.tolist(), opened[first].tolist()):
                    held["lists"][start][level] = _opens_list(text, int(at[i]), key)
                held["steps"][start] += int(step.sum())
            held["quotes"] = (held["quotes"] + int(quotes[-1])) % 2
            held["bytes"] += len(data)
            held["blank"] = not part.column("text")[-1].as_py().strip()
        yield from out()

    schema = pa.schema([("f", pa.string()), ("g", pa.int64()), ("size", pa.int64()), ("bytes", pa.int64()), ("quotes", pa.int32()),
                        ("steps", pa.list_(pa.int64())), ("blank", pa.bool_()), ("lists", pa.list_(pa.map_(pa.int64(), pa.bool_())))])
    return rows.mapInArrow(summarise, "f string, g long, size long, bytes long, quotes int, steps array<long>, blank boolean, "
                                      "lists array<map<bigint,boolean>>")


def _starts(summaries: DataFrame) -> DataFrame:
    """(f, g, inside, depth, listed) of each split and, in ``whole``, whether
    the file ends as it should.  Only rows of a split each are ordered here."""
    before = W.partitionBy("f").orderBy("g").rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy("f")
    s = summaries.withColumn("inside", F.pmod(F.coalesce(F.sum("quotes").over(before), F.lit(0)), F.lit(2)).cast("int"))
    s = s.withColumns({"step": F.get("steps", F.col("inside")), "opened": F.get("lists", F.col("inside"))})
    s = s.withColumn("depth", F.coalesce(F.sum("step").over(before), F.lit(0)))
    s = s.withColumn("own", F.try_element_at("opened", F.lit(LIST - 1) - F.col("depth")))
    s = s.withColumn("listed", F.coalesce(F.last("own", ignorenulls=True).over(before), F.lit(False)))
    # text behind the last brace reads like a chunk, with one byte too many
    rest = F.sum("bytes").over(every) - F.col("size")
    last = F.max_by(F.struct((F.col("depth") + F.col("step")).alias("depth"), "blank"), "g").over(every)
    quotes = F.pmod(F.sum("quotes").over(every), F.lit(2))
    ends = F.when(rest == 0, last["depth"] == 0).otherwise((last["depth"] == -1) & last["blank"])
    return s.select("f", "g", "inside", "depth", "listed", (ends & (quotes == 0)).alias("whole"))


WHOLE, HEAD, TAIL = 0, 1, 2


def _pieces(rows: DataFrame, key: bytes) -> DataFrame:
    """(f, g, h, kind, lead, body, whole) of chunks with their split's start:
    records, and per split what ends the first and begins the next one.  ``lead`` is
    what stands before the record's opening brace."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict | None = None
        rows_out: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if rows_out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows_out), schema.types)], schema=schema)
                rows_out.clear()

        def tail() -> None:
            if state:
                rows_out.append((state["f"], state["g"], state["n"], TAIL, bytes(state["lead"]), bytes(state["body"]), state["whole"]))

        for part, data, new in _runs(batches):
            if new:
                tail()
                state = {k: part.column(k)[0].as_py() for k in ("f", "g", "inside", "depth", "listed", "whole")} | {
                    "n": 0, "lead": bytearray(), "body": bytearray()}
                state["open"] = state["listed"] and state["depth"] >= RECORD
            quotes, text = _quotes(data), data.tobytes()
            at, step = _outside(data, quotes, state["inside"])
            depth = state["depth"] + np.cumsum(step, dtype=np.int64)
            listed = np.full(len(at), state["listed"])
            for i in np.flatnonzero((step > 0) & (depth == LIST)).tolist():
                listed[i:] = _opens_list(text, int(at[i]), key)
            opens = (step > 0) & (depth == RECORD) & listed & (data[at] == ord("{"))
            ends = (step < 0) & (depth == RECORD - 1) & listed & (data[at] == ord("}"))
            done = 0
            for i in np.flatnonzero(opens | ends).tolist():
                place = int(at[i])
                if opens[i]:
                    state["lead"] += text[done:place]
                    done, state["open"] = place, True
                elif state["open"]:
                    state["body"] += text[done:place + 1]
                    done = place + 1
                    rows_out.append((state["f"], state["g"], state["n"], HEAD if state["n"] == 0 else WHOLE,
                                     bytes(state["lead"]), bytes(state["body"]), state["whole"]))
                    state.update(n=state["n"] + 1, lead=bytearray(), body=bytearray(), open=False)
            (state["body"] if state["open"] else state["lead"]).extend(text[done:])
            state["inside"] = (state["inside"] + int(quotes[-1])) % 2
            state["depth"] = int(depth[-1]) if len(depth) else state["depth"]
            state["listed"] = bool(listed[-1]) if len(listed) else state["listed"]
            if len(rows_out) >= 5000:
                yield from flush()
        tail()
        yield from flush()

    schema = pa.schema([("f", pa.string()), ("g", pa.int64()), ("h", pa.int64()), ("kind", pa.int32()), ("lead", pa.binary()),
                        ("body", pa.binary()), ("whole", pa.bool_())])
    return rows.mapInArrow(cut, "f string, g long, h long, kind int, lead binary, body binary, whole boolean")


#: Between records, before the first, behind the last one.
_BETWEEN, _FIRST, _LAST = r"^\s*,\s*(null\s*,\s*)*$", r"^\s*(null\s*,\s*)*$", r"^\s*(,\s*null\s*)*$"


def _stitched(pieces: DataFrame) -> DataFrame:
    """What splits did not finish, put together in file order: the records that
    end as the first of a split, and (``last``) the rest of each file."""
    order = W.partitionBy("f").orderBy("g", "h", "kind").rowsBetween(W.unboundedPreceding, -1)
    heads = F.sum(F.when(F.col("kind") == HEAD, 1).otherwise(0)).over(order)
    edges = pieces.where(F.col("kind") != WHOLE).withColumn("group", F.coalesce(heads, F.lit(0)))
    parts = F.sort_array(F.collect_list(F.struct("g", "h", "kind", "lead", "body")))
    ends = F.max(F.when(F.col("kind") == HEAD, F.col("g")))
    by_group = edges.groupBy("f", "group", "whole").agg(parts.alias("parts"), ends.alias("g"))

    def joined(field: str) -> Column:
        return F.array_join(F.transform("parts", lambda x: x[field].cast("string")), "").alias(field)
    return by_group.select("f", F.col("g"), F.lit(-1).cast("long").alias("h"), "whole", joined("lead"), joined("body"),
                           F.col("g").isNull().alias("last"), (F.col("group") == 0).alias("alone"))


def read_records(spark: SparkSession, path: str, key: str, schema: StructType, corrupt: str) -> DataFrame:
    """One row per record of the envelopes at ``path``: order (``_ord_f`` file,
    ``_ord_g`` split, ``_ord_h`` place), the fields of ``schema`` and
    ``corrupt``, the text of what is broken.  ``null`` records give no row."""
    quoted = f'"{key}"'.encode()
    root = f"{checkpoint_root(spark).rstrip('/')}/envelopes/{uuid.uuid4().hex}"
    chunks = _chunks(spark, path)
    _starts(_summaries(chunks, quoted)).write.parquet(root)
    starts = spark.read.parquet(root)
    chunks = chunks.drop("size")
    if starts.count() <= BROADCAST_SPLITS:
        placed = chunks.join(F.broadcast(starts), ["f", "g"])
    else:
        placed = (chunks.withColumn("nth", F.monotonically_increasing_id()).join(starts, ["f", "g"])
                  .repartition("f", "g").sortWithinPartitions("f", "g", "nth").drop("nth"))
    pieces = _pieces(placed, quoted)
    inner = pieces.where(F.col("kind") == WHOLE).select(
        "f", "g", "h", "whole", F.col("lead").cast("string"), F.col("body").cast("string"),
        F.lit(False).alias("last"), F.lit(False).alias("alone"))
    rows = inner.union(_stitched(pieces))

    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    declared = StructType([*schema.fields]).add(corrupt, StringType())
    envelope = StructType().add(key, ArrayType(schema)).add(corrupt, StringType())
    lead = F.col("lead")
    between = F.when(lead.contains("["), F.regexp_extract(lead, r"(?s)^.*\[(.*)$", 1).rlike(_FIRST)).otherwise(lead.rlike(_BETWEEN))
    closed = F.when(F.col("alone"), F.from_json(lead, envelope, options)[corrupt].isNull()).otherwise(
        F.substring_index(lead, "]", 1).rlike(_LAST))
    good = F.when(F.col("last"), F.col("whole") & closed).otherwise(between)
    told = rows.select(
        F.col("f").alias("_ord_f"), F.col("g").alias("_ord_g"), F.col("h").alias("_ord_h"), "last", good.alias("good"),
        F.when(~F.col("last"), F.from_json("body", declared, options)).alias("_doc"), F.concat("lead", "body").alias("_text"))
    text = F.when(F.col("_text") == "", F.lit("(the file ends early)")).otherwise(F.col("_text"))
    bad = F.when(~F.col("good"), text).otherwise(F.col(f"_doc.{corrupt}"))
    return told.where(~F.col("last") | ~F.col("good")).select(
        "_ord_f", "_ord_g", "_ord_h", bad.alias(corrupt), *[F.col(f"_doc.{f.name}").alias(f.name) for f in schema.fields])
