"""Scalar functions of the dialect and the Spark expression each stands for; ``{0}``, ``{1}`` are its arguments."""

from __future__ import annotations

# What is not listed has the same name and arguments in Spark.
FUNCTIONS: dict[str, str] = {
    "IIF": "if({0}, {1}, {2})",
    "TRUNC": "(sign({0}) * floor(abs({0}) * pow(10, {1})) / pow(10, {1}))",
    "LIST": "listagg({0}, {1})",
    "WM_CONCAT": "listagg({0}, ',')",
    "CHAR_LENGTH": "length({0})",
    "ASCII_VAL": "ascii({0})",
    "ASCII_CHAR": "chr({0})",
    "MAXVALUE": "greatest({0}, {1})",
    "MINVALUE": "least({0}, {1})",
    "SYSDATE": "localtimestamp()",
    "SYSTIMESTAMP": "current_timestamp()",
    "TO_TIMESTAMP": "to_timestamp_ntz({0}, {1})",
    "JSON_VALUE": "get_json_object({0}, {1})",
    "JSON_QUERY": "get_json_object({0}, {1})",
    "JSON_ARRAYAGG": "to_json(collect_list({0}))",
    "JSON_OBJECTAGG": "to_json(map_from_entries(collect_list(struct({0}, {1}))))",
    "BITAND": "({0} & {1})",
    "BIN_AND": "({0} & {1})",
    "STATS_MODE": "mode({0})",
    "RATIO_TO_REPORT": "({0} / sum({0}) OVER ({1}))",
    "LAG_DIFF": "({0} - lag({0}) OVER ({1}))",
    "EXTRACT_WEEKDAY": "(dayofweek({0}) - 1)",
    "EXTRACT_YEARDAY": "(dayofyear({0}) - 1)",
    "GEN_UUID": "uuid()",
    "STARTING_WITH": "startswith({0}, {1})",
    "CONTAINING": "contains(lower({0}), lower({1}))",
    "VALIDATE_CONVERSION": "(try_cast({0} AS {1}) IS NOT NULL)",
    "CAST_DEFAULT": "coalesce(try_cast({0} AS {1}), {2})",
    "MEMBER_OF": "array_contains({1}, {0})",
    "SUBMULTISET": "(size(array_except({0}, {1})) = 0)",
    "MULTISET_UNION": "array_union({0}, {1})",
    "MULTISET_INTERSECT": "array_intersect({0}, {1})",
    "MULTISET_EXCEPT": "array_except({0}, {1})",
    "XMLELEMENT": "concat('<', {0}, '>', {1}, '</', {0}, '>')",
    "XMLEXISTS": "xpath_boolean({1}, {0})",
    "XMLQUERY": "xpath_string({1}, {0})",
}


def spark_name(name: str, *args: str) -> str:
    """A call of a dialect function as Spark SQL."""
    form = FUNCTIONS.get(name.upper())
    return form.format(*args) if form else f"{name.lower()}({', '.join(args)})"
