"""A ledger of finished stages below one output folder: commit marks, resume, removal of copies.

A stage is written as Parquet and then marked; the mark holds what was counted on the write. A job
that was killed reads what is marked and builds only the rest. A stage that nothing needs any more is
deleted, its mark stays. A mark of another input or other parameters counts as none.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyarrow import fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession

from corpusloom.session import file_system
from corpusloom.sources.jsonl import write_report

Build = Callable[[], DataFrame]


class Ledger:
    def __init__(self, spark: SparkSession, out: str, key: dict):
        self.spark, self.out = spark, out.rstrip("/")
        self._key = json.dumps(key, sort_keys=True)
        self._marks: dict[str, dict] = {}

    def mark(self, name: str) -> dict | None:
        """What is noted of a finished stage or report; None if it is not finished."""
        if name not in self._marks:
            system, place = file_system(f"{self.out}/ledger/{name}.json")
            if system.get_file_info(place).type != fs.FileType.File:
                return None
            with system.open_input_file(place) as source:
                noted = json.loads(source.read())
            if noted["key"] != self._key:
                return None
            self._marks[name] = noted
        return self._marks[name]

    def _note(self, name: str, **noted) -> None:
        noted = {"name": name, "key": self._key, **noted}
        system, place = file_system(f"{self.out}/ledger/{name}.json")
        system.create_dir(place.rsplit("/", 1)[0], recursive=True)
        # Written under another name first: a mark is there as a whole or not at all.
        with system.open_output_stream(f"{place}.part", compression=None) as out:
            out.write(json.dumps(noted, default=str).encode())
        system.move(f"{place}.part", place)
        self._marks[name] = noted

    def stage(self, name: str, build: Build, metrics: dict[str, Column] | None = None) -> DataFrame | None:
        """The table of a stage, built if it is not marked; None if it was dropped since.

        `metrics` are aggregates that the write itself collects.
        """
        path, noted = f"{self.out}/{name}", self.mark(name)
        if noted is None:
            start = time.time()
            df = build()
            seen = Observation(name)
            if metrics:
                df = df.observe(seen, *[c.alias(k) for k, c in metrics.items()])
            df.write.mode("overwrite").parquet(path)
            found = seen.get if metrics else {}
            self._note(name, seconds=round(time.time() - start, 3), metrics=found, schema=df.schema.json())
            return self.spark.read.schema(df.schema).parquet(path)
        return None if noted.get("dropped") else self.spark.read.parquet(path)

    def metrics(self, name: str) -> dict:
        return (self.mark(name) or {}).get("metrics", {})

    def done(self, name: str, act: Callable[[], None]) -> None:
        """Any other step, done once."""
        if self.mark(name) is None:
            start = time.time()
            act()
            self._note(name, seconds=round(time.time() - start, 3))

    def report(self, name: str, build: Build) -> None:
        """A report of a few rows as one JSON file, written once."""
        self.done(f"report-{name}", lambda: write_report(build(), f"{self.out}/reports/{name}"))

    def seconds(self, name: str) -> float | None:
        return (self.mark(name) or {}).get("seconds")

    def drop(self, *names: str) -> None:
        """Deletes the copies of finished stages; their marks stay."""
        for name in names:
            noted = self.mark(name)
            if noted is not None and not noted.get("dropped"):
                # Noted first: a copy that is half deleted is never read again.
                self._note(name, **{k: v for k, v in noted.items() if k not in ("name", "key")}, dropped=True)
                system, place = file_system(f"{self.out}/{name}")
                system.delete_dir(place)
