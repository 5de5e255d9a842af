"""Batches as JSON payloads and back.

The outer generators followed by a filter give what the plain ones give; the
plain ones make the optimiser test the array's size first, which would parse the
payload a second time.

One payload line holds at most ``LINE_ROWS`` rows, so encoding gathers a bounded
number of rows per group whatever the batch size.  ``first_row`` tells where a
line's rows start in their batch; payloads without it are single-line batches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import laid_out

LINE_ROWS = 10_000

FEATURES = ("feature0", "feature1", "feature2")
COLUMNAR = "first_row int, " + ", ".join(f"{c} array<string>" for c in FEATURES)
RECORD_MAP = "map<string, map<string, int>>"
NESTED_RECORD_MAP = "map<string, struct<img: array<array<array<int>>>, label: int>>"
LINES = "array<string>"


def _gather(batched: DataFrame, entry: Column) -> DataFrame:
    """One row per payload line with its entries in batch order."""
    return (
        batched.groupBy(
            "batch_no", (F.floor(F.col("row_in_batch") / LINE_ROWS) * LINE_ROWS).cast("int").alias("first_row")
        )
        .agg(F.sort_array(F.collect_list(F.struct("row_in_batch", entry.alias("entry")))).alias("entries"))
    )


def encode_columnar(batched: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """``{"first_row": .., "feature0": [..], ..}`` per line: ``batch_no, payload``."""
    lines = _gather(batched, F.struct(*columns))
    arrays = [F.col("entries.entry")[c].alias(c) for c in columns]
    return lines.select(
        "batch_no", F.to_json(F.struct("first_row", *arrays), {"ignoreNullFields": "false"}).alias("payload")
    )


def decode_columnar(payloads: DataFrame, payload: str | None = "payload", keep: Sequence[str] = ()) -> DataFrame:
    """Rows of columnar payloads: ``row_in_batch, feature0..`` plus the columns in
    ``keep``.  Short arrays are padded with null.  ``payload=None`` takes input
    whose columns are the parsed arrays already."""
    if payload is not None:
        payloads = payloads.select(*keep, F.from_json(payload, COLUMNAR).alias("p")).select(*keep, "p.*")
    return payloads.select(
        *keep,
        F.coalesce("first_row", F.lit(0)).alias("first_row"),
        F.posexplode_outer(F.arrays_zip(*FEATURES)).alias("pos", "row"),
    ).filter(F.col("pos").isNotNull()).select(*keep, (F.col("first_row") + F.col("pos")).alias("row_in_batch"), "row.*")


def encode_record_map(batched: DataFrame, pixels: str = "pixels", label: str = "label") -> DataFrame:
    """``{"0": {"feature0": .., "label": ..}, ..}`` per line."""
    lines = _gather(batched, F.struct(F.col(pixels).alias("pixels"), F.col(label).cast("int").alias("label")))

    def record(entry: Column) -> Column:
        features = F.transform(
            entry.pixels, lambda v, i: F.struct(F.concat(F.lit("feature"), i), v.cast("int"))
        )
        return F.map_concat(F.map_from_entries(features), F.create_map(F.lit("label"), entry.label))

    return _keyed_by_row(lines, record)


def encode_nested_record_map(batched: DataFrame, img: str = "img", label: str = "label") -> DataFrame:
    """``{"0": {"img": [[[..]]], "label": ..}, ..}`` per line."""
    lines = _gather(batched, F.struct(F.col(img).alias("img"), F.col(label).alias("label")))
    return _keyed_by_row(lines, lambda entry: entry)


def _keyed_by_row(lines: DataFrame, record: Callable[[Column], Column]) -> DataFrame:
    records = F.map_from_entries(F.transform(
        "entries", lambda e: F.struct(e.row_in_batch.cast("string"), record(e.entry))
    ))
    return lines.select("batch_no", F.to_json(records).alias("payload"))


def decode_record_map(payloads: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``row_in_batch, pixels, label`` with the pixels as an ordered array."""
    rows = payloads.select(*keep, F.explode_outer(F.from_json("payload", RECORD_MAP)).alias("row", "record"))
    rows = rows.filter(F.col("row").isNotNull())
    # The label is the one entry that is not a pixel.
    n_pixels = F.size("record") - F.when(F.map_contains_key("record", "label"), 1).otherwise(0)
    # By the number in their name; a name without one, or beyond the count, is no pixel.
    numbered = F.transform(F.map_entries("record"), lambda e: F.struct(
        F.regexp_extract(e.key, r"^feature(\d{1,9})$", 1).try_cast("int").alias("at"), e.value.alias("value")
    ))
    pixels = laid_out(
        F.sort_array(F.filter(numbered, lambda e: e.at < n_pixels)), n_pixels, F.lit(None).cast("int")
    )
    return rows.select(
        *keep, F.col("row").cast("int").alias("row_in_batch"), pixels.alias("pixels"),
        F.try_element_at("record", F.lit("label")).alias("label"),
    )


def decode_nested_record_map(payloads: DataFrame, keep: Sequence[str] = (), flatten: bool = False) -> DataFrame:
    """``row_in_batch, img, label``; ``flatten`` turns the image into one vector."""
    rows = payloads.select(*keep, F.explode_outer(F.from_json("payload", NESTED_RECORD_MAP)).alias("row", "record"))
    rows = rows.filter(F.col("row").isNotNull())
    img = F.flatten(F.flatten("record.img")) if flatten else F.col("record.img")
    return rows.select(
        *keep, F.col("row").cast("int").alias("row_in_batch"), img.alias("img"), F.col("record.label").alias("label")
    )


def encode_lines(batched: DataFrame, line: str = "line") -> DataFrame:
    """``["first line\\n", ..]`` per line; each text keeps its newline."""
    lines = _gather(batched, F.concat(F.col(line), F.lit("\n")))
    return lines.select("batch_no", "first_row", F.to_json("entries.entry").alias("payload"))


def decode_lines(payloads: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``pos, line`` of line payloads, the newline kept; ``pos`` counts through the
    payload lines of a batch, by their ``first_row`` if they have one."""
    first = F.coalesce("first_row", F.lit(0)) if "first_row" in payloads.columns else F.lit(0)
    lines = payloads.select(
        *keep, first.alias("first_row"), F.posexplode_outer(F.from_json("payload", LINES)).alias("pos", "line")
    ).filter(F.col("pos").isNotNull())
    return lines.select(*keep, (F.col("first_row") + F.col("pos")).alias("pos"), "line")
