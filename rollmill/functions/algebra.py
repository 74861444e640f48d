"""Keys of mathematical expressions: equal keys for equal values, however they are written.

An expression, in LaTeX or plain signs, is worked out in a finite field at fixed points: its variables stand for pseudo-random numbers there, so that
two different rational functions agree with a probability of their degree over 2**126. The field holds a square root of every prime, which gives
sums and products of square roots one value too. What the field can't hold (functions, powers with variables in them, roots of other
roots) is given a value by its name and arguments: such keys are equal only for the same writing, and ``sure`` is false.
"""

from __future__ import annotations

import hashlib
import math
import re
from fractions import Fraction
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A prime that is 3 modulo 4, so that -1 has no root in it; 3, 5 and 7 don't divide the number before it, so these roots are unique.
P = 3**80 + 806
POINTS = 2
EXACT_BITS = 4096
FACTORS = 1 << 15

Vector = list[tuple[int, int]]  # a + bi at each point

# Names of functions, of constants, and the words and signs that stand for others.
FUNCTIONS = ["sin", "cos", "tan", "cot", "sec", "csc", "arcsin", "arccos", "arctan", "sinh", "cosh", "tanh", "ln", "log", "lg", "exp"]
CONSTANTS = ["pi", "infty", "alpha", "beta", "gamma", "delta", "epsilon", "theta", "lambda", "mu", "phi", "varphi", "omega", "sigma", "tau", "rho", "zeta"]
SPELLED = {"−": "-", "–": "-", "×": "*", "·": "*", "⋅": "*", "÷": "/", "π": "\\pi ", "∞": "\\infty ", "√": "\\sqrt ", "∪": "\\cup ", "**": "^", "\\cdot": "*", "\\times": "*", "\\ast": "*", "\\div": "/"}
_DROPPED = re.compile(r"\\left(?![a-z])|\\right(?![a-z])|\\[,;!: ]|\\q?quad|~|\^\\circ|\^\{\\circ\}|°|\\?\$|\\displaystyle|\\(?:text|mathrm|mbox)\{\s*\}")
_TOKEN = re.compile(r"\s*(?:(?P<num>(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+(?![\w.]))?)|\\(?P<cmd>[A-Za-z]+|[{}%|])|(?P<name>[A-Za-z]+)|(?P<sign>[-+*/^_(){}\[\],!%|]))")
_THOUSANDS = re.compile(r"[+-]?\d{1,3}(?:(?:,|\{,\})\d{3})+(?:\.\d+)?(?:\\?%)?")
_PRODUCT = re.compile(r"[abcnxyz]+|[A-Za-z]")


class Unreadable(Exception):
    pass


class Value:
    """Numbers at all points, the rational number where it is one of moderate size, and whether another key means another value."""

    def __init__(self, at: Vector, exact: Fraction | None = None, sure: bool = True) -> None:
        self.at, self.sure = at, sure
        self.exact = exact if exact is None or max(exact.numerator.bit_length(), exact.denominator.bit_length()) <= EXACT_BITS else None

    def __add__(self, o: Value) -> Value:
        return Value([((a + c) % P, (b + d) % P) for (a, b), (c, d) in zip(self.at, o.at, strict=True)], _both(self, o, lambda x, y: x + y), self.sure and o.sure)

    def __neg__(self) -> Value:
        return Value([(-a % P, -b % P) for a, b in self.at], None if self.exact is None else -self.exact, self.sure)

    def __mul__(self, o: Value) -> Value:
        return Value([((a * c - b * d) % P, (a * d + b * c) % P) for (a, b), (c, d) in zip(self.at, o.at, strict=True)], _both(self, o, lambda x, y: x * y), self.sure and o.sure)

    def inverse(self) -> Value:
        if any(x == (0, 0) for x in self.at):
            raise Unreadable
        out = []
        for a, b in self.at:
            n = pow(a * a + b * b, -1, P)
            out.append((a * n % P, -b * n % P))
        return Value(out, 1 / self.exact if self.exact else None, self.sure)

    def times(self, n: int) -> Value:
        """The n-th power."""
        base, out = (self if n >= 0 else self.inverse()), number(Fraction(1))
        keep = self.exact is not None and abs(n) * max(self.exact.numerator.bit_length(), self.exact.denominator.bit_length()) <= EXACT_BITS
        exact = self.exact**n if keep else None
        plain = Value(base.at, None, self.sure)
        for bit in bin(abs(n))[2:]:
            out = out * out
            out = out * plain if bit == "1" else out
        return Value(out.at, exact, self.sure)


def _both(x: Value, y: Value, f):  # noqa: ANN001, ANN202
    return None if x.exact is None or y.exact is None else f(x.exact, y.exact)


def number(x: Fraction) -> Value:
    if x.denominator % P == 0:
        raise Unreadable
    return Value([(x.numerator * pow(x.denominator, -1, P) % P, 0)] * POINTS, x)


def _hashed(*parts: object) -> int:
    return int.from_bytes(hashlib.sha256(repr(parts).encode()).digest()) % P


def variable(name: str) -> Value:
    return Value([(_hashed(name, k), 0) for k in range(POINTS)])


def opaque(name: str, *args: Value) -> Value:
    return Value([(_hashed(name, k, *[x.at[k] for x in args]), 0) for k in range(POINTS)], None, False)


@lru_cache(4096)
def _prime_root(q: int) -> tuple[int, int]:
    r = pow(q, (P + 1) // 4, P)
    return (r, 0) if r * r % P == q % P else (0, pow(-q, (P + 1) // 4, P))


def _square_root(n: int) -> Value:
    """Of a positive integer, as a product of roots of primes."""
    out, q = number(Fraction(1)), 2
    while q * q <= n and q < FACTORS:
        e = 0
        while n % q == 0:
            n, e = n // q, e + 1
        if e:
            out = out * number(Fraction(q ** (e // 2))) * (Value([_prime_root(q)] * POINTS) if e % 2 else number(Fraction(1)))
        q += 1 + q % 2
    if (r := math.isqrt(n)) ** 2 == n:
        return out * number(Fraction(r))
    if n >= FACTORS * FACTORS:  # it may have factors of its own
        return out * opaque("root", number(Fraction(n)), number(Fraction(2)))
    return out * Value([_prime_root(n)] * POINTS)


def root(x: Value, d: int) -> Value:
    if d < 1 or d > 64:
        raise Unreadable
    if d == 1:
        return x
    if x.exact is not None and x.exact < 0:
        return Value([(0, 1)] * POINTS) * root(-x, 2) if d == 2 else -root(-x, d) if d % 2 else opaque("root", x, number(Fraction(d)))
    if d % 2 and math.gcd(d, P - 1) == 1 and not any(b for _, b in x.at):
        e = pow(d, -1, P - 1)
        exact = None if x.exact is None else _perfect(x.exact, d)
        return Value([(pow(a, e, P), 0) for a, _ in x.at], exact, x.sure)
    if x.exact is None:
        return opaque("root", x, number(Fraction(d)))
    if (r := _perfect(x.exact, d)) is not None:
        return number(r)
    if d == 2:
        return _square_root(x.exact.numerator) * _square_root(x.exact.denominator).inverse()
    if d % 2 == 0 and (r := _perfect(x.exact, 2)) is not None:
        return root(number(r), d // 2)
    return opaque("root", x, number(Fraction(d)))


def _perfect(x: Fraction, d: int) -> Fraction | None:
    def one(n: int) -> int | None:
        low, high = 0, 1 << (n.bit_length() // d + 1)
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if mid**d <= n else (low, mid - 1)
        return low if low**d == n else None

    if x < 0:
        return None if d % 2 == 0 or (r := _perfect(-x, d)) is None else -r
    a, b = one(x.numerator), one(x.denominator)
    return None if a is None or b is None else Fraction(a, b)


def power(x: Value, e: Value) -> Value:
    if e.exact is None:
        return opaque("power", x, e)
    if e.exact.denominator == 1:
        return x.times(e.exact.numerator)
    return root(x, e.exact.denominator).times(e.exact.numerator)


class _Reader:
    """Reads tokens from left to right: sums of products of powers."""

    def __init__(self, tokens: list[tuple[str, str]]) -> None:
        self.t, self.k = tokens, 0

    def next(self) -> tuple[str, str]:
        return self.t[self.k] if self.k < len(self.t) else ("end", "")

    def take(self, sign: str | None = None) -> tuple[str, str]:
        token = self.next()
        if token[0] == "end" or (sign is not None and token != ("sign", sign)):
            raise Unreadable
        self.k += 1
        return token

    def sum(self) -> Value:
        out = self.product()
        while self.next() in (("sign", "+"), ("sign", "-")):
            out = out + (self.product() if self.take()[1] == "+" else -self.product())
        return out

    def product(self) -> Value:
        out, kind = self.signed(), self.t[self.k - 1][0]
        while True:
            token = self.next()
            if token in (("sign", "*"), ("sign", "/")):
                self.take()
                other = self.signed()
                out = out * (other if token[1] == "*" else other.inverse())
            elif token[0] in ("name", "cmd") or token in (("sign", "("), ("sign", "{"), ("sign", "[")):
                if kind == "num" and token[1] in ("frac", "dfrac", "tfrac", "cfrac"):
                    raise Unreadable  # a sum or a product
                out = out * self.signed()
            elif token[0] == "num":
                raise Unreadable
            else:
                return out
            kind = self.t[self.k - 1][0]

    def signed(self) -> Value:
        if self.next() in (("sign", "+"), ("sign", "-")):
            return self.signed() if self.take()[1] == "+" else -self.signed()
        return self.powered()

    def powered(self) -> Value:
        out = self.ended()
        if self.next() == ("sign", "^"):
            self.take()
            out = power(out, self.signed())
        return out

    def ended(self) -> Value:
        out = self.primary()
        while self.next() in (("sign", "%"), ("cmd", "%"), ("sign", "!")):
            if self.take()[1] == "%":
                out = out * number(Fraction(1, 100))
            elif out.exact is not None and out.exact.denominator == 1 and 0 <= out.exact <= 400:
                out = number(Fraction(math.factorial(int(out.exact))))
            else:
                out = opaque("factorial", out)
        return out

    def argument(self) -> Value:
        """One brace, or one digit or letter."""
        kind, x = self.next()
        if (kind, x) == ("sign", "{"):
            return self.inside("{", "}")
        self.take()
        if kind == "num" and x.isdigit():
            if len(x) > 1:
                self.k -= 1
                self.t[self.k] = ("num", x[1:])
            return number(Fraction(int(x[0])))
        if kind == "name" and len(x) == 1:
            return variable(x)
        if kind == "cmd" and x in CONSTANTS:
            return variable(x)
        raise Unreadable

    def inside(self, a: str, b: str) -> Value:
        self.take(a)
        out = self.sum()
        self.take(b)
        return out

    def primary(self) -> Value:
        kind, x = self.take()
        if kind == "num":
            mantissa, _, e = x.lower().partition("e")
            return number(Fraction(mantissa)) * number(Fraction(10)).times(int(e or 0))
        if kind == "sign" and x in "({[":
            self.k -= 1
            return self.inside(x, {"(": ")", "{": "}", "[": "]"}[x])
        if (kind, x) == ("sign", "|") or (kind, x) == ("cmd", "|"):
            inner = self.sum()
            if self.take() != (kind, x):
                raise Unreadable
            return number(abs(inner.exact)) if inner.exact is not None else opaque("abs", inner)
        if kind == "cmd" and x in ("frac", "dfrac", "tfrac", "cfrac"):
            above = self.argument()
            return above * self.argument().inverse()
        if x == "sqrt":
            d = 2
            if kind == "cmd" and self.next() == ("sign", "["):
                e = self.inside("[", "]").exact
                if e is None or e.denominator != 1:
                    raise Unreadable
                d = int(e)
            return root(self.inside("(", ")") if self.next() == ("sign", "(") else self.argument(), d)
        if x in FUNCTIONS:
            return self.function(x)
        if kind == "cmd" and x in CONSTANTS or x in ("pi", "infty", "inf", "oo"):
            return self.named({"inf": "infty", "oo": "infty"}.get(x, x))
        if kind == "name" and _PRODUCT.fullmatch(x):
            if len(x) > 1:
                self.k -= 1
                self.t[self.k : self.k + 1] = [("name", c) for c in x]
                self.k += 1
            return Value([(0, 1)] * POINTS) if x[0] == "i" else self.named(x[0])
        raise Unreadable

    def named(self, name: str) -> Value:
        if self.next() == ("sign", "_"):
            self.take()
            name += "_" + str(self.argument().at[0])
        return variable(name)

    def function(self, name: str) -> Value:
        args, e = [], None
        while self.next() in (("sign", "_"), ("sign", "^")):
            if self.take()[1] == "_":
                args.append(self.argument())
            else:
                e = self.signed()
        args.append(self.inside("(", ")") if self.next() == ("sign", "(") else self.powered())
        out = opaque(name, *args)
        return out if e is None else power(out, e)


_OPEN, _CLOSE = {("sign", "("), ("sign", "["), ("sign", "{"), ("cmd", "{")}, {("sign", ")"), ("sign", "]"), ("sign", "}"), ("cmd", "}")}


def _parts(tokens: list[tuple[str, str]], at: tuple[str, str]) -> list[list[tuple[str, str]]]:
    """tokens cut at ``at`` outside of all brackets."""
    out, depth = [[]], 0
    for t in tokens:
        depth += (t in _OPEN) - (t in _CLOSE)
        if depth < 0:
            raise Unreadable
        if t == at and not depth:
            out.append([])
        else:
            out[-1].append(t)
    if depth:
        raise Unreadable
    return out


def _key(tokens: list[tuple[str, str]]) -> tuple[str, bool]:
    if len(joined := _parts(tokens, ("cmd", "cup"))) > 1:
        found = [_key(t) for t in joined]
        return "u" + "∪".join(sorted({k for k, _ in found})), all(s for _, s in found)
    if tokens and tokens[0] in _OPEN and tokens[-1] in _CLOSE:
        listed = _listed(tokens)
        if listed is not None:
            found = [_key(t) for t in listed]
            keys = [k for k, _ in found]
            a, b = tokens[0][1], tokens[-1][1]
            if a == "{":
                keys = sorted(set(keys))
            return f"{a}{','.join(keys)}{b}", all(s for _, s in found)
    reader = _Reader(list(tokens))
    value = reader.sum()
    if reader.next()[0] != "end":
        raise Unreadable
    return "v" + hashlib.sha256(repr(value.at).encode()).hexdigest()[:32], value.sure


def _listed(tokens: list[tuple[str, str]]) -> list[list[tuple[str, str]]] | None:
    """The members between a first and a last bracket that belong together, if there are several, or if the brackets are a set's."""
    try:
        parts = _parts(tokens[1:-1], ("sign", ","))
    except Unreadable:
        return None
    return parts if len(parts) > 1 or tokens[0] == ("cmd", "{") else None


def expression_key(text: str) -> tuple[str, bool] | None:
    """(key, sure) of a number, expression, interval, tuple or set; null for what can't be read.

    Two keys that are equal mean equal values; two that differ, and are both sure, mean different ones.
    """
    x = _DROPPED.sub(" ", text.strip())
    for a, b in SPELLED.items():
        x = x.replace(a, b)
    x = x.strip().rstrip(".").strip()
    if _THOUSANDS.fullmatch(x):
        x = x.replace("{,}", "").replace(",", "")
    tokens, at = [], 0
    while at < len(x):
        m = _TOKEN.match(x, at)
        if m is None or m.lastgroup is None:
            return None
        tokens.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    try:
        return _key(tokens) if tokens else None
    except (Unreadable, RecursionError, OverflowError, ValueError):
        return None


_KEY = "array<struct<key: string, sure: boolean>>"


def _item_keys(items: pd.Series) -> pd.Series:
    known: dict[str, dict | None] = {}

    def one(x: str | None) -> dict | None:
        if x is None:
            return None
        if x not in known:
            found = expression_key(x)
            known[x] = None if found is None else {"key": found[0], "sure": found[1]}
        return known[x]

    return items.map(lambda row: None if row is None else [one(x) for x in row])


def item_keys(items: Column) -> Column:
    """array<struct<key, sure>> of an array of texts, a null for each that can't be read; each distinct text of a batch is read once."""
    return F.pandas_udf(_item_keys, _KEY)(items)
