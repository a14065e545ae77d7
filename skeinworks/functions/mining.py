"""Observed features of exercise texts: operations, units, terms and fraction types.

Vocabularies are parameters of any size. Their forms go into one automaton, which finds all of them in
one pass over a text; of those whose neighbours allow it, the leftmost counts, and of those the longest.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import ahocorasick
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from skeinworks.functions.numbers import fraction_type, parse_number
from skeinworks.session import short_batches

# How numbers and operators are written, and their precedence and names.
_NUMBER = r"(?:\d+又\d+/\d+|\d+(?:\.\d+)?(?:/\d+)?)(?!%)"
_SIGNS = "+\\-×÷*"
PRECEDENCE = {"+": 1, "-": 1, "×": 2, "÷": 2, "*": 2}
SIGN_NAMES = {"+": "加法", "-": "减法", "×": "乘法", "*": "乘法", "÷": "除法"}
_CHAIN = re.compile(rf"(?<![\d./])({_NUMBER}(?:\s*[{_SIGNS}]\s*{_NUMBER})+)(?![\d./])")
_PART = re.compile(rf"({_NUMBER})|([{_SIGNS}])")
_FRACTION = re.compile(r"(?<![\d./])(\d+又\d+/\d+|\d+/\d+)(?![\d./])")
#: A unit that is no unit before one of these characters (a corner in a shape's name, an hour in a word for time).
NOT_BEFORE = {"角": "形", "时": "间候刻"}
#: Units that texts do not tell by their name (money by the word for minutes), and those that they tell by another form only.
UNTOLD = frozenset(("分(货币)",))
TOLD_BY = {"度": ("°",)}


def folded(text: str) -> str:
    return unicodedata.normalize("NFKC", text).translate(str.maketrans("−–—", "---"))


def normal_term(text: str) -> str:
    return re.sub(r"[\W_]+", "", unicodedata.normalize("NFKC", text)).lower()


# ---- forms


class Form(NamedTuple):
    """A written form, the name it stands for, and what its neighbours must be."""

    text: str
    name: str
    after: str = ""  # a digit, a digit or gap, or anything: "digit", "gap", ""
    spaced: bool = False  # one blank may stand before it
    apart: bool = False  # no Latin letter or digit may follow
    exempt: str = ""  # characters after it that make it part of another word: found, but not counted


def unit_forms(aliases: dict[str, Iterable[str]]) -> list[Form]:
    """Forms of units by name. Latin ones follow a digit, single characters a digit or a gap to fill in.

    Spellings with brackets tell units apart on paper, not in texts. The bare character for hours is too
    common a part of words; the whole word for them counts, and after a digit with a blank too.
    """
    found: dict[str, Form] = {}
    for name, others in aliases.items():
        if name in UNTOLD:
            continue
        for form in TOLD_BY.get(name, (name, *others)):
            key = unicodedata.normalize("NFKC", form).lower()
            if not key or set(key) & set("(（，") or key == "时":
                continue
            latin = bool(re.fullmatch(r"[a-z0-9²³/]+", key))
            found[key] = Form(key, name, "digit" if latin else "gap" if len(key) == 1 else "", latin, latin, NOT_BEFORE.get(key, ""))
    return list(found.values())


def term_forms(terms: Iterable[str], least: int = 2, but: Iterable[str] = ()) -> list[Form]:
    """Forms of terms without what is no letter or digit; those shorter than ``least`` or among ``but`` are left out. Of equal forms the last term counts."""
    out = set(but)
    found = {n: Form(n, t) for t in sorted(set(terms)) if len(n := normal_term(t)) >= least and t not in out and n not in out}
    return list(found.values())


class Matcher:
    """An automaton of forms, built once in each process that uses it."""

    def __init__(self, forms: Iterable[Form]):
        self.forms = list(forms)
        self._automaton: ahocorasick.Automaton | None = None

    def __getstate__(self) -> list[Form]:
        return self.forms

    def __setstate__(self, forms: list[Form]) -> None:
        self.forms, self._automaton = forms, None

    def _candidates(self, text: str) -> Iterator[tuple[int, int, Form]]:
        """(first, end, form) of every form whose neighbours allow it; a blank before it is part of it."""
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for f in self.forms:
                self._automaton.add_word(f.text, f)
            self._automaton.make_automaton()
        for last, f in self._automaton.iter(text):
            first, end = last - len(f.text) + 1, last + 1
            before, after = text[first - 1 : first], text[end : end + 1]
            if f.apart and re.match(r"[a-z0-9]", after):
                continue
            if f.spaced and before.isspace() and text[first - 2 : first - 1].isdigit():
                yield first - 1, end, f
            elif not f.after or before.isdecimal() or f.after == "gap" and (before in ("_", ")") or before.isspace()):
                yield first, end, f

    def names(self, text: str) -> list[str]:
        """Names of the forms in the text, leftmost and longest first, none inside another."""
        if not self.forms:
            return []
        found, at = set(), 0
        for first, end, f in sorted(self._candidates(text), key=lambda c: (c[0], -len(c[2].text))):
            if first >= at:
                at = end
                if not (f.exempt and text[end : end + 1] and text[end : end + 1] in f.exempt):
                    found.add(f.name)
        return sorted(found)


# ---- one text


def division_mode(left: str, right: str, tail: str) -> str | None:
    """What becomes of a division that does not come out even, by the text after it."""
    a, b = parse_number(left), parse_number(right)
    if a is None or b is None or a.kind != "int" or b.kind != "int":
        return None
    if b.value == 0 or a.value % b.value == 0:
        return None
    if re.search(r"…|\.\.\.|余", tail):
        return "remainder"
    return "decimal_quotient" if re.match(r"\s*=\s*\d+\.\d+", tail) else "unknown"


def mine_operations(text: str) -> list[tuple[str, str, str, str | None]]:
    """(operation, left, right, mode) of every step whose operands are both written numbers.

    A chain is read with precedence: an operand that is the result of another step does not count. A
    chain that runs into a word describes something and is skipped, unless the word tells a remainder.
    """
    text, out = folded(text), []
    for chain in _CHAIN.finditer(text):
        after = text[chain.end() : chain.end() + 1]
        if "一" <= after <= "鿿" and after not in "余…":
            continue
        numbers = [m.group(1) for m in _PART.finditer(chain.group(1)) if m.group(1)]
        signs = [m.group(2) for m in _PART.finditer(chain.group(1)) if m.group(2)]
        rank = [0, *(PRECEDENCE[s] for s in signs), 0]
        for i, sign in enumerate(signs):
            if rank[i] < rank[i + 1] >= rank[i + 2]:
                mode = division_mode(numbers[i], numbers[i + 1], text[chain.end() : chain.end() + 14]) if sign == "÷" else None
                out.append((SIGN_NAMES[sign], numbers[i], numbers[i + 1], mode))
    return out


def mine_fraction_types(text: str) -> list[str]:
    found = {fraction_type(parse_number(m.group(1))) for m in _FRACTION.finditer(folded(text))}
    found |= {name for name in ("带分数", "假分数", "真分数") if name in text}
    return sorted(found - {None})


def mine_terms(text: str, terms: Matcher) -> list[str]:
    """Terms (of ``term_forms``) in the text, read without what is no letter or digit."""
    return terms.names(normal_term(folded(text)))


def mine_units(text: str, units: Matcher) -> list[str]:
    """Units (of ``unit_forms``) that the text measures in."""
    return units.names(folded(text).lower())


# ---- columns

OPERATIONS = "array<struct<op: string, left: string, right: string, mode: string>>"


def _column(text: Column, kind: str, of) -> Column:
    """``of`` each text. Texts may be long, so a worker gets few at a time."""
    short_batches(SparkSession.active())

    def mined(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else of(t))

    return F.pandas_udf(mined, kind)(text)


def operations_in(text: Column) -> Column:
    """``mine_operations`` of a column; null texts give null, as in all columns here."""
    return _column(text, OPERATIONS, lambda t: [dict(zip(("op", "left", "right", "mode"), x, strict=True)) for x in mine_operations(t)])


def fraction_types_in(text: Column) -> Column:
    return _column(text, "array<string>", mine_fraction_types)


def normal_terms(text: Column) -> Column:
    """``normal_term`` of a column."""
    return _column(text, "string", normal_term)


def terms_in(text: Column, terms: Iterable[Form]) -> Column:
    matcher = Matcher(terms)
    return _column(text, "array<string>", lambda t: mine_terms(t, matcher))


def units_in(text: Column, units: Iterable[Form]) -> Column:
    matcher = Matcher(units)
    return _column(text, "array<string>", lambda t: mine_units(t, matcher))
