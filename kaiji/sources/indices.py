"""Index constituent lists as a Spark data source.

``spark.read.format("index_weights").option("index", <name>).load(folder)`` reads the
files of one registered index; every index gives the same rows, whatever its
files call their columns. Small files share an input partition; a file is read as
a stream of Arrow batches, of which only the two columns are kept.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from kaiji import fs
from kaiji.functions.codes import normalize_code

HEAD_BYTES = 65_536  # the header line lies within these
BLOCK_BYTES = 1 << 20
PARTITION_BYTES = 64 << 20  # files of one input partition together; a larger file has one of its own
OPEN_BYTES = 1 << 20  # what opening a file counts for
SCHEMA = "index_name string, snap_key string, code string, weight double"


@dataclass(frozen=True)
class IndexFormat:
    """How the files of one index are written."""

    title: str
    code: str  # patterns that find the two columns by their header
    weight: str
    decimal_codes: bool  # codes may have come through a spreadsheet as 1301.0
    encoding: str = "cp932"


# The five indices, their titles and header words.
PAPER = {"code": "コード|Code", "weight": "ウ[エェ][イー]ト|Weight", "decimal_codes": True}
EXCHANGE = {"code": "コード|Code", "weight": "ウエ[イー]ト|Weight", "decimal_codes": False}
INDICES = {
    "Nikkei225": IndexFormat("日経225", **PAPER),
    "NikkeiHighDiv50": IndexFormat("日経高配当50", **PAPER),
    "JPXNikkei400": IndexFormat("JPX日経400", **PAPER),
    "JPXNikkeiMidSmall": IndexFormat("JPX日経中小型", **PAPER),
    "TOPIX": IndexFormat("TOPIX", **EXCHANGE),
}


def _column(header: list[str], pattern: str, path: str) -> str:
    found = next((c for c in header if re.search(pattern, c, re.IGNORECASE)), None)
    if found is None:
        raise ValueError(f"no column for {pattern} in {path}: {header}")
    return found


def weights(texts: pa.Array, path: str) -> pa.Array:
    """``12.5%`` or ``12.5`` as a number, a bare ``%`` or blank as 0; null stays null, other text is an error."""
    bare = pc.utf8_trim_whitespace(pc.replace_substring(texts, "%", ""))
    try:
        return pc.cast(pc.if_else(pc.equal(bare, ""), "0", bare), pa.float64())
    except pa.ArrowInvalid as e:
        raise ValueError(f"weight in {path}: {e}") from e


def read_file(path: str, form: IndexFormat) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(codes, weights) of one file, batch by batch.

    Rows without code or weight (footnotes) and lines with another number of fields are dropped; an
    empty file has no rows; a file whose header lacks a column is an error."""
    with fs.open_input(path) as f:
        head = f.read(HEAD_BYTES)
    if not head.strip():
        return
    line = head.split(b"\n", 1)[0].rstrip(b"\r").decode(form.encoding)
    header = next(csv.reader([line]))
    code, weight = _column(header, form.code, path), _column(header, form.weight, path)
    options = pacsv.ConvertOptions(column_types={code: pa.string(), weight: pa.string()}, include_columns=[code, weight],
                                   strings_can_be_null=True, null_values=[""])
    with fs.open_input(path) as f:
        batches = pacsv.open_csv(f, pacsv.ReadOptions(encoding=form.encoding, block_size=BLOCK_BYTES, column_names=header, skip_rows=1),
                                 pacsv.ParseOptions(invalid_row_handler=lambda row: "skip"), options)
        for batch in batches:
            codes = pc.utf8_trim_whitespace(batch.column(0))
            keep = pc.and_(pc.fill_null(pc.not_equal(codes, ""), False), pc.is_valid(batch.column(1)))
            codes, texts = codes.filter(keep), batch.column(1).filter(keep)
            if form.decimal_codes:
                codes = pc.replace_substring_regex(codes, r"\.0$", "")
            yield codes, weights(texts, path)


class IndexFiles(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


def packed(files: list[tuple[str, int]]) -> list[list[str]]:
    """Files (path, bytes) in order, in groups of up to ``PARTITION_BYTES``."""
    groups, room = [], -1
    for path, size in files:
        room -= size + OPEN_BYTES
        if room < 0:
            groups.append([])
            room = PARTITION_BYTES - size - OPEN_BYTES
        groups[-1].append(path)
    return groups


class IndexReader(DataSourceReader):
    def __init__(self, index: str, folder: str):
        self.index, self.folder = index, folder

    def partitions(self) -> list[IndexFiles]:
        return [IndexFiles(g) for g in packed(fs.files(self.folder)) or [[]]]

    def read(self, partition: IndexFiles) -> Iterator[pa.RecordBatch]:
        for path in partition.paths:
            day = re.search(r"/snap_key=([^/]+)/", path)
            for codes, numbers in read_file(path, INDICES[self.index]):
                n = len(codes)
                yield pa.record_batch([pa.array([self.index] * n, pa.string()), pa.array([day and day[1]] * n, pa.string()), codes, numbers],
                                      names=["index_name", "snap_key", "code", "weight"])


class IndexWeights(DataSource):
    """Files of one index; ``snap_key`` is the folder of that name in a file's path, null without one."""

    @classmethod
    def name(cls) -> str:
        return "index_weights"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> IndexReader:
        index = self.options.get("index")
        if index not in INDICES:
            raise ValueError(f"index {index} isn't one of {', '.join(INDICES)}")
        return IndexReader(index, self.options["path"])


def read_index(spark: SparkSession, index: str, folder: str) -> DataFrame:
    """(index_name, snap_key, code, weight) of one registered index, codes normalised."""
    spark.dataSource.register(IndexWeights)
    raw = spark.read.format(IndexWeights.name()).option("index", index).load(folder)
    return raw.withColumn("code", normalize_code("code", "JP"))
