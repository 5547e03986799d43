"""The legacy dialect: tokens, a parser for its objects, and their translation to Spark SQL and DataFrames."""

from .parser import DialectError, parse_script
from .rewrite import translate_query
from .translate import Translation, translate, translate_text

__all__ = ["DialectError", "Translation", "parse_script", "translate", "translate_query", "translate_text"]
