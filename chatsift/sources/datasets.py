"""Dataset sources: splits, JSON lines, done-id sets, column checks, config.

Path probing happens once on the driver through the Hadoop FileSystem of the
session, so the same code reads local folders, HDFS or object stores.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATA_SUFFIXES = (".parquet", ".jsonl", ".json")


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (sorted), hidden ones skipped."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def _format_of(path: str) -> str:
    return "json" if path.endswith((".jsonl", ".json")) else "parquet"


def read_any(spark: SparkSession, path: str, fmt: str | None = None,
             schema: T.StructType | str | None = None) -> DataFrame:
    """Read parquet or JSON lines; the format comes from the suffix unless given."""
    fmt = fmt or _format_of(path.rstrip("/"))
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "json":
        return reader.json(path)
    return reader.format(fmt).load(path)


def load_split(spark: SparkSession, path: str, split: str = "train",
               fmt: str | None = None) -> DataFrame:
    """Read one split of a saved dataset.

    Looks for ``path/split`` (a folder), then ``path/split.<parquet|jsonl|json>``;
    when neither exists, ``path`` itself is one dataset and ``split`` is ignored.
    """
    base = path.rstrip("/")
    candidates = [f"{base}/{split}"] + [f"{base}/{split}{s}" for s in DATA_SUFFIXES]
    for cand in candidates:
        if path_exists(spark, cand):
            inner_fmt = fmt
            if inner_fmt is None and cand.endswith(split):
                inner_fmt = _sniff_folder_format(spark, cand)
            return read_any(spark, cand, inner_fmt)
    if path_exists(spark, base):
        return read_any(spark, base, fmt or _sniff_folder_format(spark, base))
    raise FileNotFoundError(f"No dataset at {path!r} (split {split!r})")


def _sniff_folder_format(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.getFileStatus(p).isDirectory():
        return _format_of(path)
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.endswith((".json", ".jsonl")):
            return "json"
        if name.endswith(".parquet"):
            return "parquet"
    return None


def pick_split(spark: SparkSession, path: str) -> str:
    """``train`` when present, else the first split folder (sorted by name)."""
    splits = list_dirs(spark, path)
    if not splits:
        raise FileNotFoundError(f"No split folders under {path!r}")
    return "train" if "train" in splits else splits[0]


def read_dataset(spark: SparkSession, name: str, split: str = "train",
                 subset: str | None = None, fmt: str | None = None) -> DataFrame:
    """Read ``name/subset/split`` when a subset (named config) is given, else :func:`load_split`."""
    if subset:
        return load_split(spark, f"{name.rstrip('/')}/{subset}", split, fmt)
    return load_split(spark, name, split, fmt)


def read_jsonl_strict(spark: SparkSession, path: str, schema) -> DataFrame:
    """JSON lines where any malformed line fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def done_ids_from_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Distinct ids of the well-formed JSON objects among text lines.

    Blank, malformed and id-less lines are skipped, as the resume logic needs.
    Ids come back as strings (numbers keep their JSON text).
    """
    parsed = F.from_json(F.col(value_col), "id string", {"mode": "PERMISSIVE"})
    return (
        lines.select(parsed["id"].alias("id"))
        .where(F.col("id").isNotNull())
        .distinct()
    )


def read_done_ids(spark: SparkSession, path: str) -> DataFrame:
    """The set of ids already written to a JSON-lines sink; empty when missing."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "id string")
    return done_ids_from_lines(spark.read.text(path))


def require_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Fail at plan time when a required column is absent."""
    for c in cols:
        if c not in df.columns:
            raise ValueError(f"no column {c!r} among {df.columns}")
    return df


def load_config(path: str) -> dict:
    """YAML config -> dict (empty file -> {})."""
    import yaml

    with open(path) as fh:
        return yaml.safe_load(fh) or {}
