"""listledger: a de-duplicated ledger of listings gathered from web pages,
built as Spark DataFrame jobs."""

__version__ = "0.1.0"
