"""File name masks: ``{name}``, ``{day:%Y%m%d}``, ``{number:03d}`` and one level of ``[optional]`` parts, over a whole name."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftwright.errors import FilenameError

# Digits of each directive that a mask may use, and its Java letters.
_DIGITS = {"%Y": (4, "yyyy"), "%m": (2, "MM"), "%d": (2, "dd"), "%H": (2, "HH"), "%M": (2, "mm"), "%S": (2, "ss")}
_PARTS = re.compile(r"\{(?P<name>\w+)(?::(?P<spec>[^}]+))?\}|(?P<open>\[)|(?P<close>\])|(?P<text>[^{}\[\]]+)|(?P<bad>.)", re.S)


@dataclass(frozen=True)
class Mask:
    """``regex`` has one group for each facet, in order; ``kinds`` says what each is: str, int, or a strptime format."""

    regex: str
    kinds: dict[str, str]

    def match(self, name: str) -> dict[str, str | int | date] | None:
        """The facets of a name, without those of an optional part that isn't there; None if the name doesn't fit."""
        m = re.fullmatch(self.regex, name)
        if m is None:
            return None
        out: dict[str, str | int | date] = {}
        for text, (facet, kind) in zip(m.groups(), self.kinds.items()):
            if text is not None:
                out[facet] = text if kind == "str" else int(text) if kind == "int" else datetime.strptime(text, kind).date()
        return out

    def columns(self, name: Column) -> dict[str, Column]:
        """Each facet as an expression over a name: null where the name doesn't fit or the part isn't there."""
        fits = name.rlike(f"^(?:{self.regex})$")
        out = {}
        for k, (facet, kind) in enumerate(self.kinds.items(), 1):
            text = F.regexp_extract(name, f"^(?:{self.regex})$", k)
            given = F.when(fits & (text != ""), text)
            if kind == "int":
                given = given.try_cast("long")
            elif kind != "str":
                given = F.try_to_timestamp(given, F.lit("".join(_DIGITS[d][1] for d in re.findall("%.", kind)))).cast("date")
            out[facet] = given
        return out


def compile_mask(mask: str) -> Mask:
    regex, kinds, inside = "", {}, False
    for m in _PARTS.finditer(mask):
        if m["open"]:
            if inside:
                raise ValueError(f"{mask!r}: an optional part inside another")
            inside, regex = True, regex + "(?:"
        elif m["close"]:
            if not inside:
                raise ValueError(f"{mask!r}: ] without [")
            inside, regex = False, regex + ")?"
        elif m["text"]:
            regex += re.escape(m["text"])
        elif m["bad"]:
            raise ValueError(f"{mask!r}: a brace that belongs to no facet")
        else:
            name, spec = m["name"], m["spec"]
            if name in kinds:
                raise ValueError(f"{mask!r}: {name} stands twice")
            if spec is None:
                regex, kinds[name] = regex + r"([^_./]+)", "str"
            elif (n := re.fullmatch(r"0(\d+)d", spec)) and int(n[1]):
                regex, kinds[name] = regex + rf"(\d{{{int(n[1])}}})", "int"
            elif re.fullmatch(r"(?:%.)+", spec) and all(d in _DIGITS for d in re.findall("%.", spec)):
                regex, kinds[name] = regex + rf"(\d{{{sum(_DIGITS[d][0] for d in re.findall('%.', spec))}}})", spec
            else:
                raise ValueError(f"{mask!r}: unknown spec {spec!r}")
    if inside:
        raise ValueError(f"{mask!r}: [ without ]")
    return Mask(regex, kinds)


def parse(mask: str, name: str) -> dict[str, str | int | date]:
    found = compile_mask(mask).match(name)
    if found is None:
        raise FilenameError(f"{name!r} doesn't fit {mask!r}", "filename-does-not-match-mask", filename=name, mask=mask)
    return found
