"""User-defined functions: scalar, vectorised, iterator and SQL-registered forms.

They exist because the operator *is* a UDF. Where only the value matters,
``functions.text.first_letter`` computes it inside the JVM.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Iterator, Tuple

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bikeflow import schemas
from bikeflow.functions import geo
from bikeflow.sources.places import open_place

SQL_FIRST_LETTER = "first_letter_of"
SQL_ROUTE = "route_between"


def first_letter(text: str | None) -> str | None:
    return text if text is None else text[:1]


def first_letters(text: pd.Series) -> pd.Series:
    return text.str.slice(0, 1)


# From a function; Arrow moves the rows in batches instead of pickling each one.
first_letter_scalar = F.udf(first_letter, T.StringType(), useArrow=True)


@F.udf(returnType=T.StringType(), useArrow=True)
def first_letter_decorated(text: str) -> str:
    return text if text is None else text[:1]


@F.pandas_udf(T.StringType())
def first_letter_vectorised(text: pd.Series) -> pd.Series:
    return text.str.slice(0, 1)


first_letter_vectorised_call = F.pandas_udf(first_letters, T.StringType())


@F.pandas_udf(T.StringType())
def first_letter_iterator(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for text in batches:
        yield text.str.slice(0, 1)


def register(spark: SparkSession) -> None:
    """Make the vectorised form callable from SQL text."""
    spark.udf.register(SQL_FIRST_LETTER, first_letter_vectorised)


# A provider maps (source lat, source lon, destination lat, destination lon) to the steps of
# the route, each with "distance" in metres and "duration" in seconds.
RouteProvider = Callable[[float, float, float, float], Iterable[dict]]


# What a provider may fail with: no answer, or an answer that is no route.
PROVIDER_FAILURES = (OSError, ValueError)


@dataclass(frozen=True)
class Asking:
    """How a provider is asked within a task.

    ``workers`` calls run at a time. A call that fails with one of ``retried`` is repeated up to ``tries`` times, after
    ``pause`` seconds at first and twice as long each time; what fails otherwise, or to the end, with one of ``failures`` becomes the
    row's ``error``; any other error is a mistake in the program and fails the query. Answers go to the ``answers``
    folder, if given, every ``chunk`` rows, and a repeated task begins with those that it finds there.
    """

    failures: tuple[type[Exception], ...] = PROVIDER_FAILURES
    retried: tuple[type[Exception], ...] = (ConnectionError, TimeoutError)
    workers: int = 8
    tries: int = 4
    pause: float = 0.2
    answers: str | None = None
    chunk: int = 64


class _Answers:
    """What the task of one partition has been answered, as small files that only ever are added."""

    def __init__(self, folder: str):
        task = TaskContext.get()
        self.system, path = open_place(f"{folder}/part-{task.partitionId() if task else 0:06d}")
        self.system.create_dir(path, recursive=True)
        self.path, self.held = path, {}
        for info in self.system.get_file_info(fs.FileSelector(path)):
            if info.path.endswith(".json"):
                with self.system.open_input_stream(info.path) as f:
                    self.held.update((tuple(pair), tuple(answer)) for pair, answer in json.loads(f.read()))

    def add(self, found: list) -> None:
        """A file under its final name is whole: it is written under another one first."""
        if found:
            name = f"{self.path}/{uuid.uuid4().hex}"
            with self.system.open_output_stream(f"{name}.new") as out:
                out.write(json.dumps(found).encode())
            self.system.move(f"{name}.new", f"{name}.json")
            self.held.update((tuple(pair), tuple(answer)) for pair, answer in found)


def route_enricher(provider: RouteProvider, asking: Asking = Asking()) -> Callable[..., Column]:
    """Vectorised UDF that asks ``provider`` for each row."""

    def one(point: tuple) -> tuple:
        for turn in range(asking.tries):
            try:
                steps = list(provider(*point))
                metres = sum(s["distance"] for s in steps)
                seconds = sum(s["duration"] for s in steps)
                return round(metres / 1000, 1), float(round(seconds, 0)), None
            except asking.failures as failure:
                if turn + 1 == asking.tries or not isinstance(failure, asking.retried):
                    return None, None, f"Error: {failure}"
                time.sleep(asking.pause * 2**turn)

    def routes(
        batches: Iterator[Tuple[pd.Series, pd.Series, pd.Series, pd.Series]],
    ) -> Iterator[pd.DataFrame]:
        store = _Answers(asking.answers) if asking.answers else None
        known = store.held if store else {}
        with ThreadPoolExecutor(asking.workers) as pool:
            for columns in batches:
                points, fresh = list(zip(*(c.tolist() for c in columns))), {}
                left = list(dict.fromkeys(p for p in points if p not in known))
                for at in range(0, len(left), asking.chunk):
                    part = left[at : at + asking.chunk]
                    answers = dict(zip(part, pool.map(one, part)))
                    fresh |= answers
                    if store:
                        store.add([(p, a) for p, a in answers.items() if a[2] is None])
                rows = [known[p] if p in known else fresh[p] for p in points]
                yield pd.DataFrame(rows, columns=["distance_km", "duration_s", "error"])

    return F.pandas_udf(routes, schemas.ROUTE_RESULT)


def register_route(spark: SparkSession, provider: RouteProvider) -> None:
    """Make the provider callable from SQL text."""
    spark.udf.register(SQL_ROUTE, route_enricher(provider))


def great_circle_route(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Default provider: straight line at cycling speed, all in column arithmetic."""
    km = geo.great_circle_km(lat1, lon1, lat2, lon2)
    return F.struct(
        F.round(km, 1).alias("distance_km"),
        F.round(km * (3600 / geo.CYCLING_KM_PER_HOUR), 0).alias("duration_s"),
        F.lit(None).cast("string").alias("error"),
    )
