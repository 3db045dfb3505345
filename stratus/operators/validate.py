"""Record validation, normalisation and three-way routing.

One pass over the raw text: every field is decoded as text, coerced with
``try_cast`` behind strict patterns (lax: numeric text -> number, boolean -> 1 or
0, integral float -> int, ISO text or epoch number -> timestamp; text fields take
JSON strings only), checked against its rules, and every failure is collected into
an ``errors`` array.  Valid and invalid are filters on ``size(errors)``, so a
record can never be in both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.functions.text import is_blank, strip_lower, title_case
from stratus.schemas import DOUBLE_FIELDS, INT_FIELDS, OBSERVATION_FIELDS, RAW_TEXT_SCHEMA
from stratus.sources.lake import open_writers

# Inclusive valid ranges (None = unbounded) and their messages.
RANGES = {
    "temperature": (-80, 60, "Temperature is out of valid range -80 to 60"),
    "feels_like": (-80, 60, "Temperature is out of valid range -80 to 60"),
    "humidity": (0, 100, "Humidity must be between 0 and 100"),
    "pressure": (800, 1100, "Pressure must be between 800 and 1100 hPa"),
    "cloudiness": (0, 100, "Cloudiness must be between 0 and 100"),
}
WIND_MSG = "Wind speed cannot be negative"
CITY_MSG = "City cannot be empty"
# Error types and messages (pydantic-style codes).
MSG = {
    "missing": "Field required",
    "float_parsing": "Input should be a valid number, unable to parse string as a number",
    "int_parsing": "Input should be a valid integer, unable to parse string as an integer",
    "int_from_float": "Input should be a valid integer, got a number with a fractional part",
    "datetime_parsing": "Input should be a valid datetime",
    "string_type": "Input should be a valid string",
}
# What counts as a number and as a time in text.
NUMBER = r"(?i)^[+-]?(\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?$|^[+-]?(nan|inf|infinity)$"
ISO_TIME = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
FLOAT_FIELDS = DOUBLE_FIELDS
INTEGER_FIELDS = INT_FIELDS
TYPED_FIELDS = [f for f in OBSERVATION_FIELDS if f != "recorded_at"]
ROUND_FIELDS = ["temperature", "feels_like", "wind_speed"]

# Topic names of the three routed streams.
TOPIC_RAW = "raw_weather_stream"
TOPIC_VALID = "validated_weather_stream"
TOPIC_INVALID = "invalid_weather_stream"
TOPICS = [TOPIC_RAW, TOPIC_VALID, TOPIC_INVALID]


ERROR_TYPE = "array<struct<loc:string,type:string,msg:string,input:string>>"


def _err(loc: str, typ: str, msg: str, raw: Column | None) -> Column:
    """A one-element error list (lists are concatenated with ``flatten``)."""
    return F.array(F.struct(F.lit(loc).alias("loc"), F.lit(typ).alias("type"), F.lit(msg).alias("msg"),
                            (raw if raw is not None else F.lit(None).cast("string")).alias("input")))


def decode_lax(raw: DataFrame, value: str = "value") -> DataFrame:
    """Every field as text (``_t_<field>``) and the JSON kind it was sent as (``_k_<field>``); extra fields dropped.

    The decode runs inside a generator (``inline``) so it happens once per
    row: a plain projection would let filter pushdown copy the JSON parse
    into every rule that reads a field.
    """
    text = F.col(value).cast("string")
    both = F.struct(F.from_json(text, RAW_TEXT_SCHEMA).alias("_record"), F.try_parse_json(text).alias("_json"))
    decoded = raw.select("*", F.inline(F.array(both)))
    kinds = [F.schema_of_variant(F.try_variant_get("_json", f"$.{f}", "variant")).alias(f"_k_{f}") for f in TYPED_FIELDS]
    fields = [F.col(f"_record.{f}").alias(f"_t_{f}") for f in RAW_TEXT_SCHEMA.fieldNames()]
    return decoded.select(*raw.columns, F.inline(F.array(F.struct(*kinds, *fields))))


def _field(name: str) -> Column:
    return F.col(f"_t_{name}")


def _once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` and further columns, each evaluated once per row whatever reads it.

    Like the decode they come out of a generator, which no filter or projection
    above it is merged with.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def _number(name: str) -> Column:
    """A numeric field as double: a JSON number, numeric text, or a JSON boolean as 1 or 0; else null."""
    txt = F.trim(_field(name))
    flag = F.when(_field(name) == "true", 1.0).when(_field(name) == "false", 0.0)
    return F.when(F.col(f"_k_{name}") == "BOOLEAN", flag).when(txt.rlike(NUMBER), txt.try_cast("double"))


def _time(txt: Column) -> Column:
    """ISO date or date and time, or seconds since 1970 (milliseconds beyond 2e10); else null."""
    epoch = F.when(txt.rlike(NUMBER), txt.try_cast("double"))
    seconds = F.when(F.abs(epoch) > 2e10, epoch / 1000).otherwise(epoch)
    return F.when(txt.rlike(ISO_TIME), F.try_to_timestamp(txt)).when(
        F.abs(seconds) < 2e11, F.timestamp_micros((seconds * 1000000).try_cast("long")))


def check(raw: DataFrame, value: str = "value") -> DataFrame:
    """Add typed, normalised fields (``v_<field>``), ``errors`` and ``is_valid``."""
    df = _once(decode_lax(raw, value), {f"_n_{f}": _time(_field(f)) if f == "recorded_at" else _number(f)
                                        for f in ["recorded_at", *FLOAT_FIELDS, *INTEGER_FIELDS]})
    typed: dict[str, Column] = {}
    errs: list[Column] = []
    for f in OBSERVATION_FIELDS:
        txt = _field(f)
        missing = txt.isNull()
        if f in FLOAT_FIELDS:
            v = F.col(f"_n_{f}")
            e = F.when(missing, _err(f, "missing", MSG["missing"], None)) \
                 .when(v.isNull(), _err(f, "float_parsing", MSG["float_parsing"], txt))
            if f in RANGES:
                lo, hi, m = RANGES[f]
                e = e.when(~v.between(lo, hi), _err(f, "value_error", "Value error, " + m, txt))
            if f == "wind_speed":
                e = e.when(v < 0, _err(f, "value_error", "Value error, " + WIND_MSG, txt))
            typed[f] = F.round(v, 2) if f in ROUND_FIELDS else v
        elif f in INTEGER_FIELDS:
            d = F.col(f"_n_{f}")
            iv = d.try_cast("int")
            e = F.when(missing, _err(f, "missing", MSG["missing"], None)) \
                 .when(d.isNull() | F.isnan(d), _err(f, "int_parsing", MSG["int_parsing"], txt)) \
                 .when(d != F.floor(d), _err(f, "int_from_float", MSG["int_from_float"], txt)) \
                 .when(iv.isNull(), _err(f, "int_parsing", MSG["int_parsing"], txt))
            if f in RANGES:
                lo, hi, m = RANGES[f]
                e = e.when(~iv.between(lo, hi), _err(f, "value_error", "Value error, " + m, txt))
            typed[f] = iv
        elif f == "recorded_at":
            ts = F.col(f"_n_{f}")
            e = F.when(missing, _err(f, "missing", MSG["missing"], None)) \
                 .when(ts.isNull(), _err(f, "datetime_parsing", MSG["datetime_parsing"], txt))
            typed[f] = ts
        else:
            # A list or an object never has the kind STRING; a record that is no JSON has no kind at all.
            e = F.when(missing, _err(f, "missing", MSG["missing"], None)) \
                 .when(F.col(f"_k_{f}") != "STRING", _err(f, "string_type", MSG["string_type"], txt))
            if f == "city":
                e = e.when(is_blank(txt), _err(f, "value_error", "Value error, " + CITY_MSG, txt))
                typed[f] = title_case(txt)
            elif f == "weather_description":
                typed[f] = strip_lower(txt)
            else:
                typed[f] = txt
        errs.append(e)
    # Each rule gives [] or [error]; flatten keeps every failure in field order.
    no_error = F.array().cast(ERROR_TYPE)
    errors = F.flatten(F.array(*[F.coalesce(e, no_error) for e in errs]))
    out = _once(df, {"errors": errors}).select(*df.columns, *[c.alias(f"v_{f}") for f, c in typed.items()], "errors")
    return out.withColumn("is_valid", F.size("errors") == 0)


def normalized(checked: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Valid records in their normalised form."""
    keep = keep or []
    return (checked.filter("is_valid")
                   .select(*keep, *[F.col(f"v_{f}").alias(f) for f in OBSERVATION_FIELDS]))


def invalid(checked: DataFrame, keep: list[str] | None = None) -> DataFrame:
    keep = keep or []
    return checked.filter(~F.col("is_valid")).select(*keep, "errors")


def error_rows(checked: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per (record, failed rule).

    A record without errors gives no row of itself.  The generator reads an
    expression: of a plain column Spark infers a filter, pushes it below the
    projection and evaluates all rules again there, beyond what generated code holds.
    """
    keep = keep or []
    return checked.select(*keep, F.inline(F.concat("errors", F.array().cast(ERROR_TYPE))))


def message_key(checked: DataFrame) -> Column:
    """Topic key: the city as sent; ``unknown`` only when absent."""
    return F.coalesce(_field("city"), F.lit("unknown"))


def route(checked: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """raw always; valid -> normalised record; invalid -> {raw, errors}.

    A single pass: each input row expands to its two output messages with
    ``inline`` over an array of (topic, key, value) structs.
    """
    keep = keep or []
    norm_json = F.to_json(F.struct(*[
        (F.date_format(F.col(f"v_{f}"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx") if f == "recorded_at"
         else F.col(f"v_{f}")).alias(f) for f in OBSERVATION_FIELDS]))
    bad_json = F.to_json(F.struct(F.col(value).cast("string").alias("raw"), F.col("errors").alias("errors")))
    key = message_key(checked)

    def msg(topic, v):
        return F.struct(F.lit(topic).alias("topic"), key.alias("key"), v.alias("value"))

    second = F.when(F.col("is_valid"), msg(TOPIC_VALID, norm_json)).otherwise(msg(TOPIC_INVALID, bad_json))
    return checked.select(*keep, F.inline(F.array(msg(TOPIC_RAW, F.col(value).cast("string")), second)))


def write_routed(routed: DataFrame, target: str, fmt: str = "parquet", options: dict | None = None) -> None:
    """Publish routed messages.

    Kafka: one write, the ``topic`` column names each row's topic.  Files:
    one table partitioned by topic (a single pass, no per-topic re-scan);
    ``partition`` / ``offset`` / ``timestamp`` columns, when present, are kept
    so a topic folder can feed the streaming file source.
    """
    meta = [c for c in ("partition", "offset", "timestamp") if c in routed.columns]
    out = routed.select("topic", "key", "value", *meta)
    if fmt == "kafka":
        out.write.format("kafka").options(**(options or {})).save()
        return
    with open_writers(out.sparkSession, len(TOPICS)):
        out.write.mode("append").format(fmt).partitionBy("topic").save(target)
