"""Alert records as text messages.

A template is plain text with placeholders ``{member:format}`` that name members
of the alert's JSON detail (or a column of the record); ``{a+b:path}`` joins the
members that are present. A template becomes one expression, so rendering is a
projection over the alert table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from string import Formatter

from pyspark.sql import DataFrame

from weirgauge.functions.expr import aggregate, as_date, name, text
from weirgauge.operators.envelope import KEYS

MISSING = "n/a"


NUMERIC = "decimal(38,12)"

#: Placeholder formats: SQL type read from the detail, and how it is printed.
#: Percentages are rounded first because format_number alone rounds half to even.
FORMATS: dict[str, tuple[str, Callable[[str], str]]] = {
    "text": ("string", lambda v: f"cast({v} as string)"),
    "count": (NUMERIC, lambda v: f"format_number({v}, 0)"),
    "money": (NUMERIC, lambda v: f"format_number(round({v}, 2), 2)"),
    "pct": (NUMERIC, lambda v: f"format_number(round({v}, 1), 1)"),
    "share": (NUMERIC, lambda v: f"format_number(round({v} * 100, 1), 1)"),
}


@dataclass(frozen=True)
class MessageTemplate:
    """Text of one alert type; ``items`` gives the line printed per element of an array member."""

    text: str
    items: Mapping[str, str] = field(default_factory=dict)


def _placeholders(template: str) -> list[tuple[str, str | None, str]]:
    return [(literal, member, spec or "text") for literal, member, spec, _ in Formatter().parse(template)]


def _of_record(member: str) -> bool:
    return member in KEYS and member != "source_table"


def _fill(template: str, items: Mapping[str, str], owner: str) -> str:
    parts: list[str] = []
    for literal, member, spec in _placeholders(template):
        if literal:
            parts.append(text(literal))
        if member is None:
            continue
        value = name(member) if _of_record(member) else f"{owner}.{name(member)}"
        if spec == "list":
            line = _fill(items[member], {}, "entry")
            parts.append(f"coalesce(array_join(transform({value}, entry -> concat('\n• ', {line})), ''), '')")
        elif spec == "path":
            members = ", ".join(f"{owner}.{name(m)}" for m in member.split("+"))
            parts.append(f"concat_ws(' / ', {members})")
        else:
            shown = [FORMATS[spec][1](value)]
            if FORMATS[spec][0] == NUMERIC and owner == "d":  # too large for an exact decimal: as a double
                shown.append(FORMATS[spec][1](f"try_cast(get_json_object(detail, '$.{member}') as double)"))
            parts.append(f"coalesce({', '.join(shown)}, '{MISSING}')")
    return f"concat({', '.join(parts)})"


def _members(template: str) -> dict[str, str]:
    """Detail members a text asks for, with the type they are read as."""
    found: dict[str, str] = {}
    for _, member, spec in _placeholders(template):
        if member is not None and spec != "list" and not _of_record(member):
            found.update(dict.fromkeys(member.split("+"), FORMATS[spec][0] if spec in FORMATS else "string"))
    return found


def _detail_schema(templates: Mapping[str, MessageTemplate]) -> str:
    """One schema with every member any template asks for."""
    scalars: dict[str, str] = {}
    lists: dict[str, dict[str, str]] = {}
    for template in templates.values():
        scalars.update(_members(template.text))
        for member, line in template.items.items():
            lists.setdefault(member, {}).update(_members(line))
    fields = [f"{name(m)} {kind}" for m, kind in scalars.items()]
    for member, inner in lists.items():
        fields.append(f"{name(member)} array<struct<{', '.join(f'{name(m)}: {kind}' for m, kind in inner.items())}>>")
    return ", ".join(fields)


def render(alert_rows: DataFrame, templates: Mapping[str, MessageTemplate]) -> DataFrame:
    """One message per alert: ``alert_type, issue_type, message``.

    A template is looked up by issue type first, then by alert type; an alert
    of neither is printed with its record and raw detail, so none is lost.
    Numbers are read from the detail as exact decimals.
    """
    parsed = alert_rows.selectExpr(*KEYS, "detail", f"from_json(detail, {text(_detail_schema(templates))}) as d")
    filled = {k: _fill(t.text, t.items, "d") for k, t in templates.items()}
    arms = [f"when {column} = {text(k)} then {m}" for column in ("issue_type", "alert_type") for k, m in filled.items()]
    parts = ", ".join(f"coalesce(cast({c} as string), '{MISSING}')" for c in (*KEYS, "detail"))
    chosen = f"case {' '.join(arms)} end" if arms else "cast(null as string)"
    return parsed.selectExpr("alert_type", "issue_type", f"coalesce({chosen}, concat_ws(' | ', {parts})) as message")


def _all_clear_row(as_of: dt.date | str, message: str) -> dict[str, str]:
    done = text("all_clear")
    return {"alert_type": done, "issue_type": done, "message": text(message.format(date=as_date(as_of)))}


def all_clear(alert_rows: DataFrame, as_of: dt.date | str, message: str) -> DataFrame:
    """One row if there are no alerts, none otherwise. Looks at a single alert at most."""
    seen = aggregate(alert_rows.limit(1), "count(1) as n")
    row = _all_clear_row(as_of, message)
    return seen.where("n = 0").selectExpr(*[f"{value} as {column}" for column, value in row.items()])


def messages(
    alert_rows: DataFrame, templates: Mapping[str, MessageTemplate], as_of: dt.date | str, clear_text: str
) -> DataFrame:
    """What one run has to say: a message per alert in report order, or the single all-clear.

    Any number of alerts is sorted by Spark; nothing is gathered into one row.
    The checks behind ``alert_rows`` are evaluated for both branches, so pass a
    published table where that matters.
    """
    listed = render(alert_rows, templates).unionByName(all_clear(alert_rows, as_of, clear_text))
    return listed.orderBy("alert_type", "issue_type", "message")
