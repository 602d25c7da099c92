"""Vendor responses: landed files to documents, with rejects kept as rows.

A response row is ``vendor_id, so_number, po_number, need_serial_no,
status_code, reason, body`` (one document per order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.common import is_blank
from ..functions.status import ERROR, map_status
from ..operators.flatten import extract_path, has_path
from ..session import share_library
from ..sizing import broadcast_if_small
from .xml import xml_to_json

RESPONSE_SCHEMA = (
    "vendor_id bigint, so_number string, po_number string, need_serial_no boolean, "
    "status_code int, reason string, body string, content_type string"
)

# A second document of an order: one per invoice, or one for all of its numbers.
SECOND_SCHEMA = "vendor_id bigint, so_number string, invoice_number string, status_code int, reason string, body string"

# Accepted HTTP statuses (inclusive).
ACCEPTED_STATUS = (200, 209)


def read_landed(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Landed response files with the fixed schema; nothing is inferred."""
    return spark.read.schema(RESPONSE_SCHEMA).format(fmt).load(path)


def transport_error(status_code: Column, body: Column) -> Column:
    """Why a response is skipped before parsing, NULL when it is fine."""
    return F.when(F.coalesce(F.length(body), F.lit(0)) == 0, "empty body").when(
        ~F.coalesce(status_code.between(*ACCEPTED_STATUS), F.lit(False)), "http status"
    )


def read_json_responses(df: DataFrame, mode: str = "quarantine") -> DataFrame:
    """Parse JSON bodies to ``doc`` and tag every row with ``reject_reason``.

    ``mode='fail'`` aborts on a malformed body instead of tagging it.
    """
    tagged = df.withColumn("doc", F.try_parse_json("body"))
    malformed = F.col("doc").isNull()
    if mode == "fail":
        bad = F.when(malformed, F.raise_error(F.concat(F.lit("malformed body of order "), F.col("so_number"))).cast("string"))
    elif mode == "quarantine":
        bad = F.when(malformed, _why_unparsed(F.col("body")))
    else:
        raise ValueError(f"mode must be 'quarantine' or 'fail', not {mode!r}")
    return tagged.withColumn(
        "reject_reason", F.coalesce(transport_error(F.col("status_code"), F.col("body")), bad)
    )


def valid_responses(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected_responses(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("reject_reason").isNotNull()).drop("doc")


#: A body of more than this many bytes may not fit into one VARIANT.
DOCUMENT_BYTES = 128 * 1024 * 1024


def _why_unparsed(body: Column) -> Column:
    """A body that does not parse is malformed, unless it is JSON that is too large for one document."""
    large = F.octet_length(body) > DOCUMENT_BYTES
    is_json = F.from_json(body, "map<string,string>").isNotNull()
    return F.when(large & is_json, "body over the size of one document").otherwise("malformed body")


def read_xml_responses(df: DataFrame) -> DataFrame:
    """Parse XML bodies to ``doc``; tags rows as the JSON reader does.

    Any root and any tags: an element that repeats is a list, one occurrence carries
    no position; attributes are ``@name``, an element's own text beside attributes or
    other elements is ``#text``, an empty element is null, and all values stay text.
    ``body`` becomes the JSON text of the parsed document, with the root element around it.
    """
    share_library(df.sparkSession)
    error = transport_error(F.col("status_code"), F.col("body"))
    parsed = df.withColumn("_json", xml_to_json(F.when(error.isNull(), F.col("body"))))
    reason = F.coalesce(error, F.when(F.col("_json").isNull(), "malformed body"))
    tagged = parsed.withColumn("reject_reason", reason).withColumn("body", F.coalesce("_json", "body")).drop("_json")
    return tagged.withColumn("doc", F.when(F.col("reject_reason").isNull(), F.try_parse_json("body")))


def require_body_path(df: DataFrame, dotted: str | Column, doc: str = "doc") -> DataFrame:
    """Drop documents where the path is missing or null.

    With a column of paths, a row without a path requires nothing.
    """
    found = has_path(F.col(doc), dotted)
    return df.filter(found if isinstance(dotted, str) else dotted.isNull() | found)


def attach_order_context(documents: DataFrame, requests: DataFrame, on: list[str]) -> DataFrame:
    """Give each document its order's number and serial flag."""
    context = requests.select(
        *on, F.col("so_number").alias("__sales_order_number__"), F.col("need_serial_no").alias("__need_serial_number__")
    )
    return documents.join(context, on, "inner")


def route_by_connection_type(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(api rows, xml rows, rejects)`` by ``connection_type``."""
    kind = F.coalesce(F.col("connection_type"), F.lit(""))
    return (
        df.filter(kind == "api"),
        df.filter(kind == "xml"),
        df.filter(~kind.isin("api", "xml")).withColumn("reject_reason", F.lit("unknown connection type")),
    )


def read_routed(df: DataFrame, vendors: DataFrame | None = None) -> DataFrame:
    """Responses of all vendors with ``doc`` and ``reject_reason``, each read as its vendor's ``connection_type`` says.

    ``vendors`` has ``vendor_id, connection_type``; without it all are JSON. Other types are rejected.
    """
    if vendors is None:
        return read_json_responses(df)
    kinds = broadcast_if_small(vendors.select("vendor_id", "connection_type"))
    api, xml, others = route_by_connection_type(df.join(kinds, "vendor_id", "left"))
    tagged = read_json_responses(api).unionByName(read_xml_responses(xml))
    return tagged.unionByName(others.withColumn("doc", F.lit(None).cast("variant"))).drop("connection_type")


Path = str | Column | None


def error_to_status(
    df: DataFrame,
    status_map: Column,
    status_path: Path,
    message_path: Path,
    fault_status_path: Path = None,
    fault_message_path: Path = None,
) -> DataFrame:
    """Failed responses to ``status_from_vendor`` and ``vendor_message``.

    The value at the vendor's error path counts, else the one at its fault path;
    without either only the defaults apply. Paths are texts, or columns where
    they differ by vendor.
    """
    doc = F.try_parse_json("body")

    def at(path: Path) -> Column:
        return F.lit(None).cast("string") if path is None else extract_path(doc, path, "string")

    def first_of(path: Path, fault: Path) -> Column:
        return F.coalesce(*[F.when(~is_blank(at(p)), at(p)) for p in (path, fault)])

    status = map_status(first_of(status_path, fault_status_path), status_map)
    message = first_of(message_path, fault_message_path)
    return df.withColumn("status_from_vendor", F.when(is_blank(status), ERROR).otherwise(status)).withColumn(
        "vendor_message", F.when(is_blank(message), F.col("reason")).otherwise(message)
    )

