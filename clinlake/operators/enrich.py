"""Batch calls to a record endpoint, and checks on the responses."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESPONSE_SCHEMA = (
    "response_headers string, response_url string, response_time_seconds double, "
    "response_status_code int, response_text string"
)
NUMBERS = {"response_time_seconds": "float64", "response_status_code": "Int32"}
Transport = Callable[[str, str, str | None], Mapping]


def call_endpoint(df: DataFrame, base_url: str, connect: Callable[[], Transport]) -> DataFrame:
    """Send each (http_method, resource, action, data) row and append the response.

    ``connect`` runs once per partition and returns ``send(method, url, data)``,
    which gives a mapping of the response fields. A row without a resource and a
    failing call both produce an ``error`` instead of stopping the job. Arrow
    batches bound the memory per task; repartition the input to set how many
    calls run at once.
    """
    names = [*df.columns, *[p.split()[0] for p in RESPONSE_SCHEMA.split(", ")], "error"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        send = connect()
        for batch in batches:
            rows = []
            for method, resource, action, data in zip(batch["http_method"], batch["resource"], batch["action"], batch["data"]):
                rows.append(_call(send, base_url, method, resource, action, data))
            out = {c: batch[c].reset_index(drop=True) for c in batch.columns}
            for c in names[len(out) :]:
                values = [r.get(c) for r in rows]
                out[c] = pd.Series(values, dtype=NUMBERS.get(c, "object"))
            # Python strings throughout: string extension arrays may come in chunks.
            yield pd.DataFrame({c: v.astype(object) if pd.api.types.is_string_dtype(v) else v for c, v in out.items()})

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(run, f"{kept}, {RESPONSE_SCHEMA}, error string")


def _text(value) -> str | None:
    return None if value is None or pd.isna(value) else str(value)


def _call(send: Transport, base_url: str, method, resource, action, data) -> dict:
    resource = _text(resource)
    if not resource:
        return {"error": "error: resource required"}
    url = f"{base_url}{resource}/{_text(action) or ''}"
    try:
        return {"error": None, **send((_text(method) or "get").lower(), url, _text(data))}
    except Exception as error:
        return {"error": str(error) or type(error).__name__}


def response_checks(responses: DataFrame, label: str, expected: Mapping[str, int]) -> DataFrame:
    """Per label: calls, mean latency, and whether every call gave the expected status."""
    wanted = F.create_map(*[F.lit(x) for pair in expected.items() for x in pair])
    ok = F.coalesce(F.col("response_status_code") == wanted[F.col(label)], F.lit(False))
    return responses.groupBy(label).agg(
        F.count("*").alias("calls"),
        F.count_if(ok).alias("passed"),
        F.round(F.avg("response_time_seconds"), 6).alias("avg_seconds"),
        F.max("response_status_code").alias("max_status"),
        F.every(ok).alias("all_passed"),
    )


def gate(checks: DataFrame) -> DataFrame:
    """Pass the check rows on, or fail the job when a label did not pass."""
    stop = F.when(~F.col("all_passed"), F.raise_error(F.lit("response checks failed")))
    return checks.where(stop.isNull())


def chain_summary(steps: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """One text per row: all steps passed, or the list of steps without a result."""
    missing = F.concat_ws(", ", *[F.when(F.col(c).isNull(), f"{title} FAILED") for c, title in names.items()])
    return steps.withColumn("result", F.when(missing == "", "ALL STEPS PASSED").otherwise(missing))
