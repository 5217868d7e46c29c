"""Envelope unpacking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.timefmt import clean_ts, parse_clean_ts, parse_ts


def explode_envelopes(envelopes: DataFrame, stypes: list[str] | None = None) -> DataFrame:
    """One row per reading of each upload (D21: ``DT`` is a JSON array).

    Accepts either parsed columns ``FR, TS, DT`` or one JSON string column
    ``value`` holding the whole envelope (as read from Kafka or text files).
    Output: ``vin, ts, stype, value, send_ts``; timestamps in either
    spelling are parsed once.  With ``stypes`` only readings of these types are
    wanted: the others leave the array before their times are parsed.
    """
    if "DT" not in envelopes.columns:
        envelopes = envelopes.select(F.from_json(F.col("value"), S.ENVELOPE).alias("_e")).select("_e.*")
    # times are parsed in the array, below the generator, so a later filter on them does not parse them again; an outer one, since
    # of the other Spark asks the array's size first, by parsing it once more: ``_here`` leaves out the row of an upload without readings
    items = F.from_json(F.col("DT"), S.PAYLOAD)
    if stypes is not None:
        items = F.filter(items, lambda r: r["stype"].isin(*stypes))
    readings = F.transform(items, lambda r: F.struct(clean_ts(r["ts"]).alias("ts"), r["stype"].alias("stype"), r["value"].alias("value")))
    readings = F.transform(readings, lambda r: F.struct(parse_clean_ts(r["ts"]).alias("ts"), r["stype"].alias("stype"), r["value"].alias("value"),
                                                             F.lit(True).alias("_here")))
    return (envelopes.select(F.col("FR").alias("vin"), parse_ts(F.col("TS")).alias("send_ts"), readings.alias("_readings"))
            .select("vin", "send_ts", F.inline_outer("_readings")).where("_here").select("vin", "ts", "stype", "value", "send_ts"))


def split_envelopes(envelopes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable readings of all uploads (as :func:`explode_envelopes`), and what cannot be used.

    The second frame has one row for each upload whose payload cannot be read and for
    each reading of the others that lacks something: ``vin``, ``send_time`` and
    ``payload`` as they came (of a reading: its JSON), and ``reason`` — the first
    that holds of ``payload`` (no JSON array, or an empty one), ``vin``, ``send_time``, ``time``,
    ``stype`` and ``value``.  Every reading of every upload is in one of the two.
    """
    if "DT" not in envelopes.columns:
        parsed = F.from_json(F.col("value"), S.ENVELOPE)
        envelopes = envelopes.select(parsed.alias("_e"), F.col("value").alias("_raw")).select("_e.*", "_raw")
    else:
        envelopes = envelopes.withColumn("_raw", F.col("DT"))
    items = F.from_json(F.col("DT"), "array<string>")
    items = F.when(F.size(items) > 0, items).otherwise(F.array(F.lit(None).cast("string")))
    # an item is parsed once, in the array (never an empty one): above the generator the two filters would each parse it again for every column they need
    fields = F.transform(items, lambda i: F.struct(i.alias("_item"), F.from_json(i, "map<string,string>").alias("m")))  # numbers may be quoted
    fields = F.transform(fields, lambda r: F.struct(r["_item"].alias("_item"), clean_ts(r["m"]["ts"]).alias("_ts"), r["m"]["stype"].alias("_stype"),
                                                    r["m"]["value"].try_cast("double").alias("_value")))
    fields = F.transform(fields, lambda r: F.struct(r["_item"].alias("_item"), parse_clean_ts(r["_ts"]).alias("_ts"), r["_stype"].alias("_stype"), r["_value"].alias("_value")))
    rows = envelopes.select("FR", "TS", "_raw", parse_ts(F.col("TS")).alias("_send"), fields.alias("_fields")).select("FR", "TS", "_raw", "_send", F.inline_outer("_fields"))
    rows = rows.select("FR", "TS", F.coalesce("_item", "_raw").alias("_raw"), F.col("_item").isNull().alias("_no_item"), "_send", "_ts", "_stype", "_value")
    reason = (F.when(F.col("_no_item"), "payload").when(F.col("FR").isNull(), "vin").when(F.col("_send").isNull(), "send_time")
              .when(F.col("_ts").isNull(), "time").when(F.col("_stype").isNull(), "stype").when(F.col("_value").isNull(), "value"))
    rows = rows.withColumn("reason", reason)
    good = rows.where(F.col("reason").isNull()).select(
        F.col("FR").alias("vin"), F.col("_ts").alias("ts"), F.col("_stype").alias("stype"), F.col("_value").alias("value"), F.col("_send").alias("send_ts"))
    bad = rows.where(F.col("reason").isNotNull()).select(
        F.col("FR").alias("vin"), F.col("TS").alias("send_time"), F.col("_raw").alias("payload"), "reason")
    return good, bad


def drop_future_readings(readings: DataFrame) -> DataFrame:
    """Keep readings strictly older than their envelope's send time.

    The same function serves batch and streaming frames.
    """
    return readings.where(F.col("send_ts") > F.col("ts"))
