"""What the operators share: reading, shipping code to executors, stored intermediates, Arrow batches."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpanel.storage.shared import new_folder, remove_folder

PACKAGE = Path(__file__).resolve().parents[1]

# Fixed value: the columns of a documents table.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, tables_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{tables_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application.

    The zip goes through the shared folder: executors need not have the repository installed.
    """
    context = spark.sparkContext
    if getattr(context, "_tillpanel_shipped", False):
        return
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in sorted(PACKAGE.rglob("*.py")):
            archive.write(path, path.relative_to(PACKAGE.parent))
    target = f"{new_folder(spark, 'code')}/tillpanel_{uuid.uuid4().hex[:8]}.zip"
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(target)
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    stream.write(bytearray(buffer.getvalue()))
    stream.close()
    context.addPyFile(path.toString())
    context._tillpanel_shipped = True


def stored(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written to the shared folder and read again: computed once, and no lineage left."""
    spark = frame.sparkSession
    path = new_folder(spark, name)
    frame.write.parquet(path)
    found = spark.read.schema(frame.schema).parquet(path)
    found.stored_path = path
    return found


def discard(*frames: DataFrame) -> None:
    """Remove what ``stored`` wrote, once everything that reads it is stored itself."""
    for frame in frames:
        remove_folder(frame.sparkSession, frame.stored_path)


def in_batches(
    frame: DataFrame,
    schema: str,
    start: Callable[[], Callable[[dict[str, list]], dict[str, object] | None]],
    finish: str | None = None,
    chunk_rows: int = 1024,
) -> DataFrame:
    """Apply Python work to Arrow batches of ``frame``, partition by partition, without a shuffle.

    ``start()`` runs once per task and gives the function for one batch: columns as Python lists in,
    columns as lists or arrays out. With ``finish``, the function object has a method of that name,
    called after the last batch for the task's remaining rows. ``chunk_rows`` bounds what is in Python
    at a time.
    """
    ship_package(frame.sparkSession)
    names = [part.split()[0] for part in schema.split(",")]
    arrow_schema = arrow_fields(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()

        def made(columns):
            arrays = [pa.array(columns[n], type=arrow_schema.field(n).type) for n in names]
            return pa.RecordBatch.from_arrays(arrays, schema=arrow_schema)

        for whole in batches:
            for offset in range(0, whole.num_rows, chunk_rows):
                batch = whole.slice(offset, chunk_rows)
                columns = work({n: batch.column(n).to_pylist() for n in batch.schema.names})
                if columns is not None:
                    yield made(columns)
        if finish:
            yield from (made(columns) for columns in getattr(work, finish)())
        # Workers stay for the next task, which may need its memory elsewhere.
        pa.default_memory_pool().release_unused()

    return frame.mapInArrow(run, schema)


def arrow_fields(schema: str) -> pa.Schema:
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(),
        "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(),
        "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
        "array<double>": pa.list_(pa.float64()), "array<string>": pa.list_(pa.string()),
    }
    return pa.schema([pa.field(n, kinds[k]) for n, k in (p.split() for p in schema.split(","))])


def kept_columns(keep: tuple[str, ...], text_column: str) -> list:
    """Columns that pass through ``in_batches`` beside others, under names of their own; the text goes once."""
    return [F.col(name).alias(f"kept_{name}") for name in keep if name != text_column]


def kept_values(columns: dict[str, list], keep: tuple[str, ...], text_column: str) -> dict[str, list]:
    """What passed through, by its own names."""
    return {name: columns["text" if name == text_column else f"kept_{name}"] for name in keep}


def kept_schema(frame: DataFrame, keep: tuple[str, ...]) -> str:
    kinds = {name: kind.replace("bigint", "long") for name, kind in frame.dtypes}
    return "".join(f", {name} {kinds[name]}" for name in keep)


def id_bucket(column: str, buckets: int):
    """crc32 of the id as text, modulo ``buckets``: how rows are held out."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % buckets
