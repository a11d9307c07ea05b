"""The end-to-end job: raw files to features, models, marts and the dashboard document.

    spark-submit -m deskmeter.plans.job <stage> --raw DIR --out DIR

Stages are ``validate``, ``process``, ``ml``, ``load``, ``models``, ``dashboard``, ``lake`` (with ``--lake``) and
``all``. Each reads what the one before stored below ``--out``, and a repeated one gives the same tables. With
``--resume``, stages that have finished with the same inputs, parameters and code are skipped.
"""

from __future__ import annotations

import argparse
import hashlib
import json
import math
import time
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskmeter import schemas, sources
from deskmeter.ml import training
from deskmeter.operators import quality
from deskmeter.operators.clean import clean_tickets
from deskmeter.operators.log_features import log_features_nested
from deskmeter.operators.text_features import text_features
from deskmeter.plans import models
from deskmeter.plans.dashboard import dashboard_document
from deskmeter.session import get_session
from deskmeter.sinks.publish import Target, materialise_view, publish, publish_layers, write_document
from deskmeter.sources.inventory import check_schema, file_states, path_exists, present_sources, require_sources
from deskmeter.sources.raw import check_keys, estimated_bytes

RAW_FILES = {
    "tickets": "tickets.csv",
    "messages": "ticket_messages.jsonl",
    "events": "ticket_events.json",
}
RAW_TABLES = ("tickets_clean", "text_features", "log_features", "predictions")
BUCKET_BYTES = 512 * 1024 * 1024
OWNER = "deskmeter.out"
LAKE = {
    "processed": ("tickets_clean", "text_features", "log_features", "ml_features", "predictions"),
    "curated": ("fct_tickets", "fct_predictions", "mart_ticket_decision", "mart_ml_features"),
}


@dataclass
class Job:
    spark: SparkSession
    raw: str
    out: str
    events_indent: int | None = None
    buckets: int | None = None
    exact_split: bool = True
    target: Target | None = None
    lake: str | None = None
    resume: bool = False

    def __post_init__(self) -> None:
        self.report: list[tuple[str, str, int, float]] = []

    # -- helpers ---------------------------------------------------------------
    def _path(self, layer: str, name: str) -> str:
        return f"{self.out.rstrip('/')}/{layer}/{name}"

    def _stored(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self._path(layer, name))

    def _store(self, stage: str, layer: str, name: str, df: DataFrame) -> None:
        started = time.monotonic()
        rows = publish(df, name, Target("parquet", f"{self.out.rstrip('/')}/{layer}"))
        self.report.append((stage, name, rows, time.monotonic() - started))

    # -- stages ----------------------------------------------------------------
    def validate(self) -> None:
        """All sources are there; the lines of each are counted, and the keys that messages need are in use."""
        paths = {n: f"{self.raw.rstrip('/')}/{f}" for n, f in RAW_FILES.items()}
        require_sources(self.spark, paths)
        for name, path in paths.items():
            self.report.append(("validate", name, self.spark.read.text(path).count(), 0.0))
        needed = T.StructType([f for f in schemas.MESSAGES.fields if f.name in ("ticket_id", "body")])
        check_keys(self.spark, paths["messages"], needed)

    def process(self) -> None:
        """Raw to silver. Text and log features shrink each source before anything is joined."""
        base = self.raw.rstrip("/")
        tickets = sources.read_tickets(self.spark, f"{base}/{RAW_FILES['tickets']}")
        messages = sources.read_messages(self.spark, f"{base}/{RAW_FILES['messages']}")
        events = sources.read_events(self.spark, f"{base}/{RAW_FILES['events']}", self.events_indent)
        for name, df, schema in (
            ("tickets", tickets, schemas.TICKETS),
            ("messages", messages, schemas.MESSAGES),
            ("events", events, schemas.TICKET_EVENTS),
        ):
            check_schema(name, df, schema)
        self._store("process", "processed", "tickets_clean", clean_tickets(tickets))
        self._store("process", "processed", "text_features", text_features(messages))
        self._store("process", "processed", "log_features", log_features_nested(events))
        clean, text, logs = (
            self._stored("processed", n) for n in ("tickets_clean", "text_features", "log_features")
        )
        self._store("process", "processed", "ml_features", models.ml_features_inner(clean, text, logs))

    def ml(self) -> training.Outcome:
        outcome = training.train_evaluate(
            self._stored("processed", "ml_features"), exact=self.exact_split, stored=True
        )
        self._store("ml", "processed", "predictions", outcome.predictions)
        champion = F.lit(outcome.champion)
        self._store("ml", "processed", "model_metrics", outcome.metrics.withColumn("champion", champion))
        self._store("ml", "processed", "model_comparison", outcome.comparison)
        self._store("ml", "processed", "run_summary", outcome.summary)
        self._store("ml", "processed", "roc_curve", outcome.roc)
        stored = {n: self._stored("processed", n) for n in ("model_metrics", "model_comparison", "run_summary")}
        write_document(training.metrics_document(**stored), self._path("processed", "metrics"))
        return outcome

    def to_lake(self) -> dict[str, int]:
        """Publish what the other stages have stored to the lake's layers; absent tables are skipped."""
        if not self.lake:
            raise ValueError("the lake's place is not given")
        layers = {}
        for layer, names in LAKE.items():
            paths = present_sources(self.spark, {n: self._path(layer, n) for n in names})
            layers[layer] = {n: self.spark.read.parquet(p) for n, p in paths.items()}
        written = publish_layers(layers, self.lake)
        self.report += [("lake", name, rows, 0.0) for name, rows in written.items()]
        return written

    # -- resuming --------------------------------------------------------------
    def _fingerprint(self, stage: str, before: str) -> str:
        """What a stage depends on: the raw files, the parameters, the library's code and the stage before."""
        inputs = [file_states(self.spark, f"{self.raw.rstrip('/')}/{f}") for f in RAW_FILES.values()]
        parameters = [self.events_indent, self.buckets, self.exact_split, repr(self.target), self.lake]
        code = hashlib.sha256()
        for file in sorted(Path(__file__).resolve().parents[1].rglob("*.py")):
            code.update(file.read_bytes())
        return hashlib.sha256(json.dumps([stage, before, inputs, parameters, code.hexdigest()]).encode()).hexdigest()

    def _finished(self, stage: str) -> str | None:
        path = self._path("_stages", stage)
        return self.spark.read.text(path).first()[0] if path_exists(self.spark, f"{path}/_SUCCESS") else None

    def load(self, target: Target | None = None) -> dict[str, int]:
        """Publish the silver tables; absent ones are skipped. Catalogue tables are bucketed
        on the ticket so that the fact's joins need no exchange."""
        target = target or self.target or Target("table", "raw")
        paths = {name: self._path("processed", name) for name in RAW_TABLES}
        tables = {n: self.spark.read.parquet(p) for n, p in present_sources(self.spark, paths).items()}
        bucket = ("ticket_id", self._bucket_count(tables)) if target.fmt == "table" and tables else None
        loaded = {}
        for name, df in tables.items():
            started = time.monotonic()
            loaded[name] = publish(df, name, target, bucket=bucket)
            if target == Target("table", "raw"):
                self.spark.sql(f"ALTER TABLE raw.`{name}` SET TBLPROPERTIES ('{OWNER}' = '{self._owner()}')")
            self.report.append(("load", name, loaded[name], time.monotonic() - started))
        return loaded

    def _bucket_count(self, tables: dict[str, DataFrame]) -> int:
        """One count for all tables, so that they line up: by the size of the largest one."""
        if self.buckets:
            return self.buckets
        largest = max(estimated_bytes(df) for df in tables.values())
        floor = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return max(floor, math.ceil(largest / BUCKET_BYTES))

    def _owner(self) -> str:
        return self.out.rstrip("/").replace("\\", "\\\\").replace("'", "\\'")

    def _is_own(self, name: str) -> bool:
        """Whether the catalogue's table was loaded from this job's output and not from another run's."""
        if not self.spark.catalog.tableExists(f"raw.{name}"):
            return False
        found = self.spark.sql(f"SHOW TBLPROPERTIES raw.`{name}`").collect()
        return (OWNER, self.out.rstrip("/")) in [(r["key"], r["value"]) for r in found]

    def _raw_tables(self) -> dict[str, DataFrame]:
        """Catalogue tables that this job has loaded, else its stored files."""
        return {
            name: self.spark.table(f"raw.{name}") if self._is_own(name) else self._stored("processed", name)
            for name in RAW_TABLES
        }

    def models(self) -> list:
        """Staging views and their tests, then dimensions, facts and marts and theirs.

        The facts are stored before the marts read them, so no join runs twice. A failing
        test stops everything downstream of it.
        """
        built = {f"raw.{name}": df for name, df in self._raw_tables().items()}
        for name in models.STAGING:
            inputs, function = models.GRAPH[name]
            built[name] = function(*[built[i] for i in inputs])
            materialise_view(built[name], name)
        checks = quality.enforce(quality.report(built, quality.STAGING_CHECKS))
        for name in models.MARTS:
            inputs, function = models.GRAPH[name]
            self._store("models", "curated", name, function(*[built[i] for i in inputs]))
            built[name] = self._stored("curated", name)
        return checks + quality.enforce(quality.report(built, quality.MART_CHECKS))

    def dashboard(self) -> None:
        measured = self._stored("processed", "model_metrics")
        champion = measured.first()["champion"]
        document = dashboard_document(
            self._stored("curated", "fct_tickets"),
            self._stored("curated", "mart_ticket_decision"),
            self._stored("curated", "fct_predictions"),
            measured.drop("champion"),
            champion,
        )
        write_document(document, self._path("curated", "dashboard"))

    def run(self, stage: str = "all") -> DataFrame:
        """Run one stage or all of them; returns the run report."""
        stages: dict[str, Callable] = {
            "validate": self.validate, "process": self.process, "ml": self.ml,
            "load": self.load, "models": self.models, "dashboard": self.dashboard, "lake": self.to_lake,
        }
        if stage == "all" and not self.lake:
            del stages["lake"]
        mark = ""
        for name in stages if stage == "all" else [stage]:
            started, mark = time.monotonic(), self._fingerprint(name, mark)
            # a lone stage has no stage before it to be compared with, so it always runs
            if self.resume and stage == "all" and self._finished(name) == mark:
                self.report.append((name, "skipped", -1, 0.0))
                continue
            stages[name]()
            if stage == "all":
                write_document(self.spark.createDataFrame([(mark,)], "value string"), self._path("_stages", name))
            self.report.append((name, "*", -1, time.monotonic() - started))
        return self.spark.createDataFrame(
            self.report, "stage string, table string, n_rows bigint, seconds double"
        )


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("stage", choices=["validate", "process", "ml", "load", "models", "dashboard", "lake", "all"])
    parser.add_argument("--raw", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--events-indent", type=int, default=None)
    parser.add_argument("--buckets", type=int, default=None)
    parser.add_argument("--target", default="table", help="format of the loaded tables: table, parquet, orc, csv, json, jdbc or a connector")
    parser.add_argument("--location", default="raw", help="database, folder or URL of the target")
    parser.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="option of the target; may be repeated")
    parser.add_argument("--lake", default=None)
    parser.add_argument("--resume", action="store_true")
    args = parser.parse_args(argv)
    target = Target(args.target, args.location, dict(o.split("=", 1) for o in args.option))
    job = Job(get_session(), args.raw, args.out, args.events_indent, args.buckets, target=target, lake=args.lake, resume=args.resume)
    job.run(args.stage).show(100, truncate=False)


if __name__ == "__main__":
    main()
