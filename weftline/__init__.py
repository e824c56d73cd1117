"""weftline: web-extraction and crawl-index analytics as declarative Spark plans."""

__version__ = "0.1.0"
