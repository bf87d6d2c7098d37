from navforge.functions.parse import parse_decimal, parse_timestamp, trimmed
from navforge.functions.rules import issue_codes, violation

__all__ = ["issue_codes", "parse_decimal", "parse_timestamp", "trimmed", "violation"]
