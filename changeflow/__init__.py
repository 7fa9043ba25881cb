"""Change data capture on Spark DataFrames: decode, compact, merge, capture, verify."""

from changeflow.model import CUSTOMERS_TO_LOWER, CUSTOMERS_TO_UPPER, Column, TableMapping

__all__ = ["CUSTOMERS_TO_LOWER", "CUSTOMERS_TO_UPPER", "Column", "TableMapping"]
