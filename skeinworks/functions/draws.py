"""Seeded parameters of cards under their constraints. Only the standard library is imported, as in ``expressions``."""

from __future__ import annotations

import random
from collections.abc import Callable
from decimal import Decimal
from fractions import Fraction
from typing import Any

from skeinworks.functions.expressions import compiled
from skeinworks.functions.values import typed

TRIES = 5000


Drawn = tuple[Any, Any]


def _int_slot(s: dict) -> Callable[[random.Random], Drawn]:
    low, step = int(s["min"]), int(s.get("step") or 1)
    steps = (int(s["max"]) - low) // step

    def drawn(rng: random.Random) -> Drawn:
        v = low + step * rng.randint(0, steps)
        return v, v

    return drawn


def _decimal_slot(s: dict) -> Callable[[random.Random], Drawn]:
    unit = 10 ** int(s.get("places", 1))
    low, high = (int(Decimal(str(s[e])) * unit) for e in ("min", "max"))

    def drawn(rng: random.Random) -> Drawn:
        v = str(Decimal(rng.randint(low, high)) / unit)
        return v, Decimal(v)

    return drawn


def _fraction_slot(s: dict) -> Callable[[random.Random], Drawn]:
    low, high, most = Fraction(str(s.get("min", "0"))), Fraction(str(s.get("max", "1"))), max(2, int(s.get("max_denominator", 10)))
    (a, x), (b, y) = low.as_integer_ratio(), high.as_integer_ratio()
    ends: dict[int, tuple[int, int]] = {}

    def drawn(rng: random.Random) -> Drawn:
        v = low
        for _ in range(200):
            d = rng.randint(2, most)
            if d not in ends:
                ends[d] = int(low * d), int(high * d)
            n = rng.randint(*ends[d])
            v = Fraction(n, d)
            if a * d <= n * x and n * y <= b * d:
                break
        return f"{v.numerator}/{v.denominator}", v

    return drawn


def _choice_slot(s: dict) -> Callable[[random.Random], Drawn]:
    options = s["options"]

    def drawn(rng: random.Random) -> Drawn:
        v = rng.choice(options)
        return v, v

    return drawn


_KINDS = {"int": _int_slot, "decimal": _decimal_slot, "fraction": _fraction_slot, "choice": _choice_slot}


def sampler(slots: dict[str, dict]) -> Callable[[random.Random], tuple[dict[str, Any], dict[str, Any]]]:
    """Draws of raw and typed parameters, slot by slot from one random stream; what the slots say is read once.

    The order and the kind of the draws are fixed: equal seeds give equal parameters wherever they are drawn.
    """
    made = []
    for name, s in slots.items():
        if s.get("type") not in _KINDS:
            raise ValueError(f"unknown kind of slot: {s.get('type')}")
        made.append((name, _KINDS[s["type"]](s)))

    def one(rng: random.Random) -> tuple[dict[str, Any], dict[str, Any]]:
        raw, typed = {}, {}
        for name, drawn in made:
            raw[name], typed[name] = drawn(rng)
        return raw, typed

    return one


def sample(slots: dict[str, dict], rng: random.Random) -> dict[str, Any]:
    """One draw of raw parameters."""
    return sampler(slots)(rng)[0]


def typed_params(raw: dict[str, Any], slots: dict[str, dict]) -> dict[str, Any]:
    return {k: typed(v, slots.get(k, {}).get("type")) for k, v in raw.items()}


def test_of(constraints: list[str]) -> Callable[[dict[str, Any]], bool]:
    """All constraints as one test of typed parameters, compiled once. One that is not allowed, or fails, does not hold."""
    try:
        made = [compiled(c, logic=True) for c in constraints]
    except (ValueError, SyntaxError, KeyError, RecursionError):
        return lambda params: False

    def holds(params: dict[str, Any]) -> bool:
        try:
            return all(bool(f(params)) for f in made)
        except (ValueError, ArithmeticError, TypeError, LookupError, AttributeError, RecursionError, StopIteration, RuntimeError):
            return False

    return holds


def holds(constraints: list[str], params: dict[str, Any]) -> bool:
    return test_of(constraints)(params)


#: Verdicts of constraints on parameters that are kept at most, for each card.
KEPT = 1 << 16


class Stream:
    """The draws of one seed that meet all constraints, one after the other; ``at`` is how many there were."""

    def __init__(self, slots: dict, constraints: list[str], tries: int = TRIES) -> None:
        self.sampled, self.test, self.tries = sampler(slots), test_of(constraints), tries
        # Raw numbers tell the parameters; choices may be equal and not the same.
        self.known: dict[tuple, bool] | None = None if any(s.get("type") == "choice" for s in slots.values()) else {}

    def of(self, seed: int | random.Random) -> Stream:
        """This stream at the beginning of a seed's draws."""
        self.rng, self.at = seed if isinstance(seed, random.Random) else random.Random(seed), 0
        return self

    def next(self) -> dict[str, Any] | None:
        """The next draw; None after so many tries."""
        for _ in range(self.tries):
            raw, params = self.sampled(self.rng)
            if self._meets(raw, params):
                self.at += 1
                return raw
        return None

    def _meets(self, raw: dict[str, Any], params: dict[str, Any]) -> bool:
        if self.known is None:
            return self.test(params)
        key = tuple(raw.values())
        met = self.known.get(key)
        if met is None:
            met = self.test(params)
            if len(self.known) < KEPT:
                self.known[key] = met
        return met


def draw(slots: dict, constraints: list[str], rng: random.Random, tries: int = TRIES) -> dict[str, Any] | None:
    """The first draw that meets all constraints; None after so many tries."""
    return Stream(slots, constraints, tries).of(rng).next()


def acceptance(slots: dict, constraints: list[str], n: int = 1000, seed: int = 0) -> float:
    """The share of n draws that meet all constraints."""
    rng, sampled, test = random.Random(seed), sampler(slots), test_of(constraints)
    return sum(test(sampled(rng)[1]) for _ in range(n)) / n
