"""The gateway as one plan over a request log: authorize -> throttle -> decode -> stamp.

The order is semantic: a request with a wrong key takes no token, one over the limit is not read, and what is
read gets the authenticated tenant and the request's own time, whatever its body says.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlog.functions.keys import partition_key
from driftlog.operators.decode import MAX_BODY_BYTES, entries_of, parsed_body, refused
from driftlog.operators.ingest import authorize
from driftlog.operators.throttle import throttle
from driftlog.schemas import ENTRY_COLUMNS
from driftlog.session import ensure_checkpoint_dir

# The service's answers.
ACCEPTED, BAD_REQUEST, UNAUTHORIZED, TOO_MANY = 202, 400, 401, 429


def gateway(requests: DataFrame, keys: DataFrame, rps: float, order: Sequence[str] = ("request_id",),
            max_bytes: int = MAX_BODY_BYTES) -> tuple[DataFrame, DataFrame]:
    """(responses, messages) of requests with request_id, tenant_id, api_key, ts and body.

    responses: every request with its ``status``. messages: one row per entry of an accepted batch, with
    ``call_id`` (the request's id; entries have a request_id of their own), the bus ``key`` of the batch (tenant | its first entry's service), ``position`` and the stamped
    entry. An accepted batch without entries has no message. A body above ``max_bytes`` is a bad request.
    """
    ensure_checkpoint_dir(requests.sparkSession)
    known, unknown = authorize(requests, keys)
    metered = throttle(known, rps, order=list(order))
    body = F.col("body").cast("string")
    judged = metered.withColumn("__p", F.when(F.col("admitted") & (F.octet_length(body) <= max_bytes), parsed_body(body)))
    status = F.when(~F.col("admitted"), TOO_MANY).when(refused("__p").isNotNull(), BAD_REQUEST).otherwise(ACCEPTED)
    judged = judged.withColumn("status", status).withColumn("__p", F.when(F.col("status") == ACCEPTED, F.col("__p")))
    # a fold and a parse stand behind the status; both outputs read it and the parsed bodies from one copy
    judged = judged.drop("body", "admitted", "tokens_left").checkpoint(eager=True)
    responses = judged.select("request_id", "tenant_id", "status").unionByName(
        unknown.select("request_id", "tenant_id", F.lit(UNAUTHORIZED).alias("status")))
    raw = judged.where(F.col("status") == ACCEPTED).select(
        F.col("request_id").alias("call_id"), F.col("tenant_id").alias("sender"), F.col("ts").alias("received"), "__p",
        F.try_variant_get(F.col("__p"), "$.entries[0].service", "string").alias("first_service"))
    entries = entries_of(raw, "__p")
    stamp = {"tenant_id": F.col("sender"), "ingest_timestamp": F.col("received")}
    messages = entries.select(
        "call_id", partition_key(F.col("sender"), F.coalesce("first_service", F.lit(""))).alias("key"), "position",
        *[stamp.get(c, F.col(c)).alias(c) for c in ENTRY_COLUMNS])
    return responses, messages
