"""Joins the views a statement needs into one WITH statement."""

import re

from terrace.sources import SCHEMAS

PLAIN = {t: t for t in SCHEMAS}


def duck_raw(raw: dict[str, str]) -> dict[str, str]:
    """Raw statements with table names filled in; two functions are spelled differently in DuckDB."""
    out = {}
    for name, text in raw.items():
        filled = text.format(**PLAIN) if "{" in text else text
        filled = re.sub(r"unix_millis\(([^()]*)\)", r"(epoch_us(\1) // 1000)", filled)
        out[name] = filled.replace("AS STRING", "AS VARCHAR")
    return out


def with_needed(name: str, views: dict[str, str]) -> str:
    """WITH every view that `name` depends on, in order of use."""
    order: list[str] = []

    def visit(view: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b[a-z]\w+\b", views[view])):
            if word in views and word not in order and word != view:
                visit(word)
        if view not in order:
            order.append(view)

    visit(name)
    heads = ", ".join(f"{v} AS ({views[v]})" for v in order[:-1])
    return (f"WITH {heads} " if heads else "") + f"SELECT * FROM ({views[name]})"
