"""SQL statements that an independent engine runs to check the Spark queries."""

from oracle.statements import statements

__all__ = ["statements"]
