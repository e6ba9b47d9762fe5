"""The queries of this package and the SQL that some of them must agree with."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable
from functools import wraps

import lexigrid
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return build(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return register


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the workers, once, unless their Python path has it already."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(lexigrid.__file__)))
    paths = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    context = spark.sparkContext
    if context.master.startswith("local") and not context.master.startswith("local-"):
        paths.append(os.getcwd())
    app = context.applicationId
    if app in _shipped or root in map(os.path.abspath, paths):
        return
    folder = tempfile.mkdtemp(prefix="lexigrid-code-")
    context.addPyFile(shutil.make_archive(f"{folder}/lexigrid", "zip", root, "lexigrid"))
    _shipped.add(app)


#: Columns that operators meet under their own names; no operator uses these for its own ends.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def set_aside(docs: DataFrame, needed: tuple[str, ...], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` on ``docs``, whose columns beyond the usual and the needed ones it meets as one
    struct, so that their names cannot clash with its own.

    They come back in their places with their values.  One under whose name ``work`` adds a
    column gets underscores behind its name.
    """
    known = {c.lower() for c in (*DOCUMENT, *needed)}
    others = [c for c in docs.columns if c.lower() not in known]
    if not others:
        return work(docs)
    name = "others"
    while name in known:
        name += "_"
    held = [F.col(f"`{c}`") for c in docs.columns if c not in others]
    packed = docs.select(*held, F.struct(*[F.col(f"`{c}`") for c in others]).alias(name))
    out = work(packed)
    added = [c for c in out.columns if c not in packed.columns]
    taken = {c.lower() for c in added} | {c.lower() for c in docs.columns}
    back = []
    for column in docs.columns:
        if column not in others:
            back.append(F.col(f"`{column}`"))
            continue
        free = column
        if column.lower() in {c.lower() for c in added}:
            while free.lower() in taken:
                free += "_"
            taken.add(free.lower())
        back.append(F.col(name)[column].alias(free))
    return out.select(*back, *[F.col(f"`{c}`") for c in added])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
