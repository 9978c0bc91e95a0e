"""Browser, system and device of a user-agent string by a collection of rules, as column expressions.

A rule is a row of a table: for a ``field`` (browser, system, device) a ``pattern`` with two groups, the mark it goes by and the version,
what else must occur (``also``), and what it says: ``family``, ``version`` where it does not stand in the text, ``brand`` and ``model``. An
empty family is the mark itself, and ``$1`` stands for the mark. The first rule that holds counts; what no rule matches is ``Other``
with an empty version, and so is a missing user agent.

All rules of a field become the branches of one regular expression, which replaces the text by its groups. Only the groups of the
branch that matched are not empty, so where they stand names the rule.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable
from dataclasses import dataclass, fields
from functools import cache
from importlib import resources

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = [
    "browser_family", "browser_version", "os_family", "os_version", "device_family", "device_brand",
    "device_model", "device_is_mobile", "device_is_tablet", "device_is_pc", "device_is_bot",
    "device_is_touch_capable",
]
MOST_RULES = 5000  # of a table that the driver reads
MARK = "\x01"

# Families that decide what kind of device it is.
MOBILE_BROWSERS = [
    "Chrome Mobile", "Chrome Mobile iOS", "Chrome Mobile WebView", "Edge Mobile", "Firefox Mobile", "Firefox iOS", "IE Mobile",
    "Mobile Safari", "Mobile Safari UI/WKWebView", "Opera Mini", "Opera Mobile", "QQ Browser Mobile"]
MOBILE_SYSTEMS = ["Android", "BlackBerry OS", "KaiOS", "Symbian OS", "Windows Phone"]
TOUCH_SYSTEMS = ["Android", "BlackBerry OS", "Windows Phone", "iOS"]
TABLETS = ["iPad", "Kindle"]
APPLE_MOBILE = ["iPhone", "iPod"]


@dataclass(frozen=True)
class Rule:
    field: str
    pattern: str
    also: str = ""
    family: str = ""
    version: str = ""
    brand: str = ""
    model: str = ""

    def __post_init__(self):
        if re.compile(self.pattern).groups != 2 or re.compile(self.also).groups:
            raise ValueError(f"a pattern has two groups, what else must occur has none: {self}")

    def branch(self) -> str:
        return (f"(?=.*(?:{self.also}))" if self.also else "") + f"(?=.*?{self.pattern})"


class AgentRules:
    """Rules by field, in order."""

    def __init__(self, rules: Iterable[Rule]):
        self.by_field: dict[str, list[Rule]] = {}
        for rule in rules:
            self.by_field.setdefault(rule.field, []).append(rule)

    @classmethod
    def of_table(cls, table: DataFrame, order: str) -> AgentRules:
        """Rules from a table with the columns of ``Rule``, missing values being empty, in the order of a column."""
        names = [f.name for f in fields(Rule)]
        rows = table.orderBy(order).select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in names]).limit(MOST_RULES + 1).collect()
        if len(rows) > MOST_RULES:
            raise ValueError(f"more than {MOST_RULES} rules")
        return cls(Rule(**row.asDict()) for row in rows)

    def matched(self, ua: Column, field: str) -> Column:
        """Text that ``found`` reads: two marks for every rule before the one that holds, then its groups."""
        rules = self.by_field.get(field, [])
        groups = "".join(f"${i + 1}{MARK}" for i in range(2 * len(rules)))
        branches = "".join(f"{r.branch()}|" for r in rules)
        return F.regexp_replace(F.translate(ua, MARK, " "), f"(?s)^(?:{branches}).*$", groups)

    def found(self, matched: Column, field: str) -> dict[str, Column]:
        """family, version, brand and model (NULL if there is none) for the result of ``matched``."""
        rules, body = self.by_field.get(field, []), F.btrim(matched, F.lit(MARK))
        mark, number = F.split_part(body, F.lit(MARK), F.lit(1)), F.split_part(body, F.lit(MARK), F.lit(2))
        at = F.when(body != "", ((F.length(matched) - F.length(F.ltrim(matched, F.lit(MARK)))) / 2).cast("int"))

        def said(name: str, default: str | None = None) -> Column:
            texts = F.array(*[F.lit(getattr(r, name) or default) for r in rules]) if rules else F.array().cast("array<string>")
            return F.replace(F.get(texts, at), F.lit("$1"), mark)

        numbers = F.array_join(F.slice(F.split(F.translate(number, "_", "."), r"\."), 1, 3), ".")
        return {
            "family": F.coalesce(said("family", "$1"), F.lit("Other")), "version": F.coalesce(said("version"), numbers),
            "brand": said("brand"), "model": said("model")}


@cache
def packaged_rules() -> AgentRules:
    """The rules that come with the package."""
    text = resources.files("lakeloom.functions").joinpath("agent_rules.csv").read_text()
    return AgentRules(Rule(**row) for row in csv.DictReader(text.splitlines()))


def device_kind(ua: Column, browser: Column, system: Column, device: Column) -> dict[str, Column]:
    """The five flags. An Android device is a tablet unless it says that it is mobile."""
    tablet = device.isin(TABLETS) | ((system == "Android") & ~ua.contains("Mobile") & (browser != "Opera Mini"))
    return {
        "device_is_mobile": ~tablet & (device.isin(APPLE_MOBILE) | system.isin(MOBILE_SYSTEMS) | browser.isin(MOBILE_BROWSERS)),
        "device_is_tablet": tablet,
        "device_is_pc": ua.contains("Windows NT") | (system == "Mac OS X") & ~ua.contains("Silk")
        | (system == "Chrome OS") | (ua.contains("Linux") & ua.contains("X11")),
        "device_is_bot": device == "Spider",
        "device_is_touch_capable": system.isin(TOUCH_SYSTEMS),
    }
