from datetime import datetime, timedelta, timezone

from driftlog.schemas import LOG_ENTRY

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(seconds: float) -> datetime:
    return T0 + timedelta(seconds=seconds)


def entry(log_id="", tenant_id="t1", service="svc", level="INFO", message="m", event=None, ingest=None,
          host="", container="", environment="", trace_id="", request_id="", fields=None):
    return (log_id, tenant_id, service, host, container, environment, level, message, trace_id, request_id,
            event, ingest, fields or {})


def entries_df(spark, rows, extra=None):
    df = spark.createDataFrame(rows, LOG_ENTRY)
    return df


def col_list(df, c, order=None):
    if order:
        df = df.orderBy(*order)
    return [r[c] for r in df.select(c).collect()]
