"""Sources and sinks: stream codec, dimension tables, stage files, fixtures."""

from cdrflow.sources.cdr_json import decode_cdr, encode_cdr, read_cdr_stream, write_cdr_messages
from cdrflow.sources.dims import insert_absent, product_catalog, rate_plans, read_dim, typed_rate_plans
from cdrflow.sources.files import (
    read_invoices,
    read_jdbc,
    read_mediated,
    read_rated,
    write_invoices,
    write_jdbc,
    write_mediated,
    write_partitioned,
    write_rated,
    write_report,
)

__all__ = [
    "decode_cdr",
    "encode_cdr",
    "read_cdr_stream",
    "write_cdr_messages",
    "insert_absent",
    "product_catalog",
    "rate_plans",
    "read_dim",
    "typed_rate_plans",
    "read_invoices",
    "read_jdbc",
    "read_mediated",
    "read_rated",
    "write_invoices",
    "write_jdbc",
    "write_mediated",
    "write_partitioned",
    "write_rated",
    "write_report",
]
