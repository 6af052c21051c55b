"""The content digest of barloom.functions.digests in SQL."""
from __future__ import annotations


def row_text(columns: dict[str, str], digits: int = 6) -> str:
    """`columns`: name (or expression) to kind: int, double, date, time, text, bool."""
    forms = {"int": "{0}::VARCHAR", "double": f"CAST(round({{0}} * 1e{digits}) AS BIGINT)::VARCHAR", "date": "strftime({0}, '%Y-%m-%d')",
             "time": "strftime({0}, '%Y-%m-%d %H:%M:%S')", "text": "length({0}) || ':' || {0}", "bool": "CASE WHEN {0} THEN 'true' WHEN NOT {0} THEN 'false' END"}
    return "concat_ws('|', " + ", ".join(f"coalesce({forms[kind].format(name)}, '~')" for name, kind in columns.items()) + ")"


def digest(text: str) -> str:
    def piece(at):
        return f"coalesce(sum(('0x' || substr(md5({text}), {at}, 15))::BIGINT), 0)::VARCHAR"
    return f"concat_ws(':', count({text})::VARCHAR, {piece(1)}, {piece(16)})"
