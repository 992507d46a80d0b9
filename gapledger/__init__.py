"""Match one body of text against another on Spark and report where they conflict."""

__version__ = "0.1.0"
