"""The stream's messages: version 1 envelopes, dead letters with a triage reason, and how messages are told apart.

All of it is column expressions, so one plan serves batches and streams. What several of them use is bound to a row (``bound``): a message is parsed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventpulse.functions.events import bound

VERSION = 1
REASONS = CORRUPT, UNSUPPORTED, INVALID = "corrupt", "unsupported_version", "invalid_shape"
_ACTOR, _REPO = "struct<id:bigint,login:string>", "struct<id:bigint,name:string>"
ENVELOPE = f"v bigint, captured_at string, event struct<id:string,type:string,actor:{_ACTOR},repo:{_REPO},payload:string,public:boolean,created_at:string>"
STORE_COLUMNS = ["event_id", "type", "actor_id", "actor_login", "repo_id", "repo_name", "created_at", "captured_at", "payload"]
#: A time with an offset: naive times are refused on this path.
_AWARE = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})$"


def encode(rows: DataFrame) -> DataFrame:
    """(key, value) messages of events (id, type, actor, repo, payload, public, created_at, captured_at), nested columns being structs and times text."""
    # The payload goes in as the text that it is: parsing it would reorder keys and rewrite numbers.
    whole = F.to_json(F.struct("id", "type", "actor", "repo", "public", "created_at"))
    rows = bound(rows, _whole=whole)
    event = F.concat(F.substring("_whole", F.lit(1), F.length("_whole") - 1), F.lit(',"payload":'), F.coalesce("payload", F.lit("null")), F.lit("}"))
    value = F.concat(F.lit(f'{{"v":{VERSION},"captured_at":"'), F.col("captured_at"), F.lit('","event":'), event, F.lit("}"))
    return rows.select(F.col("repo.id").cast("string").cast("binary").alias("key"), value.cast("binary").alias("value"))


def triage(messages: DataFrame) -> DataFrame:
    """``messages`` with the parsed ``envelope`` and ``reason``, null where the message is valid.

    In this order: not UTF-8 or not JSON is corrupt, as is an empty value; no object, or another version, is unsupported; the rest of what is wrong is a shape.
    """
    raw = F.coalesce(F.col("value"), F.lit(b""))
    m = bound(messages, _text=F.when(F.is_valid_utf8(raw.cast("string")), raw.cast("string")))
    m = bound(m, _parsed=F.try_parse_json("_text"), envelope=F.from_json("_text", ENVELOPE, {"mode": "PERMISSIVE"}))
    parsed = F.col("_parsed")
    version = F.try_variant_get(parsed, "$.v", "bigint")
    kind = F.schema_of_variant(parsed)
    whole = F.schema_of_variant(F.try_variant_get(parsed, "$.v", "variant")) == "BIGINT"  # text that looks like a number is none
    exact = F.when(kind.startswith("OBJECT") & whole & F.try_variant_get(parsed, "$.v", "string").rlike(r"^\d+$"), version)
    e = F.col("envelope.event")
    times = F.col("envelope.captured_at").rlike(_AWARE) & e["created_at"].rlike(_AWARE)
    needed = [e["id"], e["type"], e["actor"]["id"], e["actor"]["login"], e["repo"]["id"], e["repo"]["name"], e["payload"]]
    whole = times
    for c in needed:
        whole = whole & c.isNotNull()
    whole = whole & F.try_to_timestamp(F.col("envelope.captured_at")).isNotNull() & F.try_to_timestamp(e["created_at"]).isNotNull()
    reason = F.when(parsed.isNull() | F.col("_text").isNull(), CORRUPT).when(F.coalesce(exact != VERSION, F.lit(True)), UNSUPPORTED).when(~F.coalesce(whole, F.lit(False)), INVALID)
    return bound(m, reason=reason).drop("_text", "_parsed")


def store_rows(valid: DataFrame) -> DataFrame:
    """Rows of the validated store, with both clocks, from triaged messages without a reason. The payload keeps its keys' order and its numbers' text, not its blanks."""
    e = F.col("envelope.event")
    return valid.select(
        e["id"].alias("event_id"), e["type"].alias("type"), e["actor"]["id"].alias("actor_id"), e["actor"]["login"].alias("actor_login"), e["repo"]["id"].alias("repo_id"), e["repo"]["name"].alias("repo_name"),
        F.try_to_timestamp(e["created_at"]).alias("created_at"), F.try_to_timestamp(F.col("envelope.captured_at")).alias("captured_at"), e["payload"].alias("payload"),
    )


def dead_letters(refused: DataFrame) -> DataFrame:
    """(key, value) messages of refused ones: version 1, reason, detail, and the original key and value in base 64."""
    detail = F.when(F.col("reason") == CORRUPT, "value is not JSON text").when(F.col("reason") == UNSUPPORTED, F.format_string("not a version %d envelope", F.lit(VERSION))).otherwise("envelope lacks a valid event")
    record = F.struct(F.lit(VERSION).alias("v"), "reason", detail.alias("detail"), F.base64("key").alias("key"), F.base64(F.coalesce(F.col("value"), F.lit(b""))).alias("value"))
    return refused.select("key", F.to_json(record, {"ignoreNullFields": "false"}).cast("binary").alias("value"))


def decode_dead_letters(messages: DataFrame) -> DataFrame:
    """(reason, detail, key, value) of dead letters; another version raises."""
    r = bound(messages.select("value"), r=F.from_json(F.col("value").cast("string"), "v bigint, reason string, detail string, key string, value string"))
    known = F.when(F.col("r.v") == VERSION, F.col("r.reason")).otherwise(F.raise_error(F.lit("unsupported dead letter")).cast("string"))
    return r.select(known.alias("reason"), F.col("r.detail").alias("detail"), F.unbase64("r.key").alias("key"), F.unbase64("r.value").alias("value"))


def hour_key(at: Column) -> Column:
    """The UTC hour bucket of an event time."""
    return F.date_format(at, "yyyy-MM-dd-HH")
