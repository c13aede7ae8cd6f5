"""Physical schemas of Parquet files, read from their footers inside the tasks."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs

NANOS = "nanoseconds"


def spark_type(kind: pa.DataType) -> str | None:
    """The Spark type to ask for; None for a column that holds nothing."""
    if pa.types.is_null(kind):
        return None
    if pa.types.is_timestamp(kind):
        if kind.unit == "ns":
            return NANOS
        return "timestamp" if kind.tz else "timestamp_ntz"
    if pa.types.is_string(kind) or pa.types.is_large_string(kind) or pa.types.is_dictionary(kind):
        return "string"
    names = {
        pa.bool_(): "boolean",
        pa.int8(): "tinyint",
        pa.int16(): "smallint",
        pa.int32(): "int",
        pa.int64(): "bigint",
        pa.float32(): "float",
        pa.float64(): "double",
        pa.date32(): "date",
    }
    if kind not in names:
        raise TypeError(f"no listing column holds {kind}")
    return names[kind]


def _open(path: str) -> pa.NativeFile:
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    system, key = fs.FileSystem.from_uri(path)
    return system.open_input_file(key)


def _fields(file: pq.ParquetFile) -> str | None:
    """Columns of a file (name and type, as JSON); None for a file without rows."""
    if file.metadata.num_rows == 0:
        return None
    # the old 96-bit times are instants, which Spark reads itself
    old = {file.schema.column(i).name for i in range(len(file.schema)) if file.schema.column(i).physical_type == "INT96"}
    columns = [(c.name, "timestamp" if c.name in old else spark_type(c.type)) for c in file.schema_arrow]
    return json.dumps(sorted((n, k) for n, k in columns if k))


def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Path and columns of each file that has rows."""
    for batch in batches:
        paths, fields = [], []
        for path in batch.column("path").to_pylist():
            with _open(path) as source:
                found = _fields(pq.ParquetFile(source))
            if found:
                paths.append(path)
                fields.append(found)
        yield pa.RecordBatch.from_pydict({"path": paths, "fields": fields}, schema=_SCHEMA)


def read_those(fields: str, schema: pa.Schema, rows: int = 10_000):
    """Reads, in the tasks, the files among the given ones that have these columns."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with _open(path) as source:
                    file = pq.ParquetFile(source, coerce_int96_timestamp_unit="us")
                    if _fields(file) != fields:
                        continue
                    for part in file.iter_batches(rows, columns=schema.names):
                        yield pa.RecordBatch.from_arrays([part.column(f.name).cast(f.type) for f in schema], schema=schema)

    return read


_SCHEMA = pa.schema([("path", pa.string()), ("fields", pa.string())])
