"""Imports every plan module so their queries register."""

from stockwise.plans import (  # noqa: F401
    analytics, catalogue, files, forecast, integrity, ledger, nested, procurement, reads, search, stored, streams, sync, tables)
