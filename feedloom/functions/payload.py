"""The stored payload of a tweet: a VARIANT, parsed once at ingest.

Every later read takes fields out of the binary value, however many receivers a
payload has; no JSON text is parsed above the fan-out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from feedloom.schemas import TWEET

TAGS = "array<struct<text:string>>"


def to_payload(value: Column) -> Column:
    """VARIANT of a raw record.

    A record that the tolerant ingest parse accepts although it is no strict JSON keeps
    the fields that the system reads."""
    return F.coalesce(F.try_parse_json(value), F.to_variant_object(F.from_json(value, TWEET)))


def is_payload(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, VariantType)


def as_payload(df: DataFrame, column: str = "tweet") -> Column:
    """The column as a payload, also where it still is raw text."""
    return F.col(column) if is_payload(df, column) else to_payload(F.col(column))


def field(payload: Column, path: str, kind: str = "string") -> Column:
    """A field of a payload; null where it is absent or of another kind."""
    return F.try_variant_get(payload, f"$.{path}", kind)


def payload_id(payload: Column) -> Column:
    return field(payload, "id_str").try_cast("bigint")


def text(payload: Column) -> Column:
    return field(payload, "text")


def text_md5(payload: Column) -> Column:
    """Digest of the whole text, where a payload comes once per receiving user."""
    return F.md5(text(payload).cast("binary"))


def digest(df: DataFrame, column: str = "tweet") -> Column:
    """Digest of a whole payload, whatever its column holds."""
    return digest_of(F.col(column)) if is_payload(df, column) else F.xxhash64(column)


def digest_of(payload: Column) -> Column:
    return F.xxhash64(F.to_json(payload))
