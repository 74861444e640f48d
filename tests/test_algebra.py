"""Keys of expressions: hand-written pairs, and random expressions against exact evaluation."""

import random
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rollmill.functions.algebra import expression_key as key

SAME = [
    ("x+1", "1+x"), (r"\sqrt{8}", r"2\sqrt{2}"), ("(1,2)", "(1, 2)"), ("1e3", "1000"), (r"\frac12", "0.5"), (r"50\%", "1/2"), (r"\frac{1}{\sqrt{2}}", r"\frac{\sqrt 2}{2}"), ("(x+1)^2", "x^2+2x+1"), (r"2\pi r", r"r*2*\pi"),
    ("1,000,000", "10^6"), ("1{,}000", "1000"), (r"[0,\infty)", "[0, ∞)"), (r"\left(-\infty,1\right]\cup[2,3)", r"[2,3)\cup(-\infty,1]"), (r"\{1,2\}", "{2,1}"), (r"\sqrt{-4}", "2i"), (r"\sqrt[3]{16}", r"2\sqrt[3]{2}"),
    ("x^{-1}", r"\frac1x"), (r"\frac{x^2-1}{x-1}", "x+1"), (r"\sqrt{2}\cdot\sqrt{3}", r"\sqrt{6}"), ("3!", "6"), ("|-3|", "3"), ("27^{1/3}", "3"), ("4^{0.5}", "2"), (r"\sin x", r"\sin(x)"), ("(3-i)(3+i)", "10"), ("$5", "5"),
    (r"45^\circ", "45"), ("x_{1}", "x_1"), ("-x^2", "-(x^2)"), ("1/2x", "x/2"), (r"\dfrac{3}{4}", "75%"), ("e^{2}", "e*e"), (r"\sqrt{12}+\sqrt{27}", r"5\sqrt3"), ("9" * 500, "9" * 500), ("1e-3", "0.001"), ("2**3", "8"),
]
DIFFERENT = [("1", "2"), ("x", "y"), (r"\sqrt2", r"\sqrt3"), ("(1,2)", "(2,1)"), ("[0,1]", "[0,1)"), ("x^2", "2x"), (r"\infty", r"-\infty"), ("9" * 500, "9" * 499 + "8"), (r"\sqrt{2}", r"-\sqrt{2}"), (r"\{1,2\}", r"\{1,3\}"), ("x_1", "x_2"), ("1/3", "0.33333333")]
UNSURE = [(r"\sin 2x", r"2\sin x\cos x"), (r"\sqrt{x^2}", "x"), ("2^x", "4^{x/2}"), (r"\sqrt{3+2\sqrt2}", r"1+\sqrt2"), (r"\log_2 8", "3")]
UNREADABLE = ["three apples", "5 cm", "", r"\frac{1}", "(1", "1)", "x=2", "1 2", r"1\frac{1}{2}", "a<b", r"\text{no}", "()", "^2", "2+", r"\sqrt[n]{x}", "1/0", "(" * 400 + "1" + ")" * 400, r"\sqrt[0]{2}", "0^{-1}", "[1,2"]


@pytest.mark.parametrize(("a", "b"), SAME)
def test_same_values(a, b):
    assert key(a) == key(b) and key(a) is not None


@pytest.mark.parametrize(("a", "b"), DIFFERENT)
def test_other_values(a, b):
    assert key(a)[0] != key(b)[0] and key(a)[1] and key(b)[1]


@pytest.mark.parametrize(("a", "b"), UNSURE)
def test_left_to_the_judge(a, b):
    assert key(a) == key(a) and not (key(a)[1] and key(b)[1])


def test_unreadable_and_large():
    assert [x for x in UNREADABLE if key(x) is not None] == []
    assert all(key(x) for x in ("9^9^9^9", "10^{1000000}", "x^{99999999999}", "1e999999999", r"\sqrt{" + "9" * 200 + "}"))


numbers = st.fractions(-50, 50, max_denominator=12)
trees = st.recursive(numbers, lambda t: st.tuples(st.sampled_from("+-*/"), t, t), max_leaves=8)


def written(tree, latex):
    if isinstance(tree, Fraction):
        if latex:
            return rf"\left(-\frac{{{-tree.numerator}}}{{{tree.denominator}}}\right)" if tree < 0 else rf"\dfrac{{{tree.numerator}}}{{{tree.denominator}}}"
        return f"({tree.numerator}/{tree.denominator})"
    op, a, b = tree
    a, b = written(a, latex), written(b, latex)
    if latex:
        return rf"\frac{{{a}}}{{{b}}}" if op == "/" else rf"\left({a}{dict(zip('+-*', ['+', '-', r' \cdot '], strict=True))[op]}{b}\right)"
    return f"({a} {op} {b})"


def value(tree):
    if isinstance(tree, Fraction):
        return tree
    op, a, b = tree
    a, b = value(a), value(b)
    return a + b if op == "+" else a - b if op == "-" else a * b if op == "*" else a / b


@settings(max_examples=150, deadline=None)
@given(trees, numbers)
def test_arithmetic_against_fractions(tree, other):
    try:
        v = value(tree)
    except ZeroDivisionError:
        assert key(written(tree, True)) is None
        return
    plain = key(f"{v.numerator}/{v.denominator}")
    assert key(written(tree, True)) == key(written(tree, False)) == plain
    assert (key(f"({other.numerator})/{other.denominator}") == plain) == (other == v)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(-9, 9), min_size=1, max_size=5), st.lists(st.integers(-9, 9), min_size=1, max_size=5))
def test_products_of_polynomials(a, b):
    def poly(c):
        return "+".join(f"({x})x^{{{k}}}" for k, x in enumerate(c))

    product = [sum(a[i] * b[k - i] for i in range(len(a)) if 0 <= k - i < len(b)) for k in range(len(a) + len(b) - 1)]
    assert key(f"({poly(a)})({poly(b)})") == key(poly(product))
    random.shuffle(product)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(-5, 5), st.integers(1, 400)), min_size=1, max_size=4), st.lists(st.tuples(st.integers(-5, 5), st.integers(1, 400)), min_size=1, max_size=4))
def test_sums_of_roots_against_squarefree_form(a, b):
    def form(terms):
        out = {}
        for c, n in terms:
            s = max(d for d in range(1, 21) if n % (d * d) == 0)
            out[n // (s * s)] = out.get(n // (s * s), 0) + c * s
        return {n: c for n, c in out.items() if c}

    def text(terms):
        return "+".join(rf"({c})\sqrt{{{n}}}" for c, n in terms)

    assert (key(text(a)) == key(text(b))) == (form(a) == form(b)) and key(text(a))[1]
