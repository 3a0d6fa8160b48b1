import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedloom.llm import privacy
from feedloom.llm.privacy import KINDS, Field, N_FEATURES, all_spans, base_spans, fit_field, personal_data, personal_data_digest

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == 1 and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == 2 and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == 3 and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["4111 1111 1111 1111", "+1 (555) 010-9999", "10.0.0.1", "256.1.1.1", "a.b@c-d.ex.org", "@", ".", "..", "-", " ", "  ", "+", "7", "12", "255", "x", "é", "(", ")", "\n", "%", "@x.y", "1.2.3.4.5", "0007"]), max_size=14))
def test_base_spans_are_those_of_the_patterns(parts):
    text = "".join(parts)
    assert base_spans(text) == brute(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab1290.@+-() %", max_size=60))
def test_base_spans_of_any_text(text):
    assert base_spans(text) == brute(text)


@pytest.mark.parametrize("text", ["9" * 200_000, "1." * 100_000, "a" * 200_000 + "@", "+1 " * 60_000, "a@" * 60_000, "1-" * 100_000])
def test_long_runs_take_no_more_than_their_length(text):
    base_spans(text)


TEXTS = [
    "write to ann.99@mail1.example.com now please or call +1 (843) 555-7672 today",
    "host 10.12.13.14 is up and pays with 4111 1111 1111 1111 here", "nothing in 2024 or 12 items costs 9.9. more",
] * 20


def test_base_spans_stay_and_more_are_found():
    field = fit_field(TEXTS)
    text = "call +1 (843) 555-7672 today, then +1 (843) 555-7672 9. and pays with 4111111111111111 and 4111111111111112 here"
    base = base_spans(text)
    found = all_spans(text, base, field)
    assert set(base) <= set(found) and found == sorted(found)
    for (a, _, b), (c, _, d) in zip(found, found[1:], strict=False):
        assert b <= c or (a, b) == (c, d) or (a, _, b) in base
    assert all_spans("plain words only", [], field) == []
    clean = "in 2024 there were 12 items at 9.9. each"
    assert all_spans(clean, base_spans(clean), field) == []


def test_skips_carry_labels_between_alike_tokens():
    """A token without evidence of its own takes the label that an equal one has elsewhere."""
    nodes, steps = np.zeros((N_FEATURES, len(KINDS) + 1)), np.zeros((len(KINDS) + 1,) * 2)
    runs, fixed = [[[0]], [[0]], [[0]]], np.array([3, 0, 0])
    without = Field(nodes, steps, 0.0).marginals(runs, ["a", "a", "b"], fixed)
    shared = Field(nodes, steps, 3.0).marginals(runs, ["a", "a", "b"], fixed)
    assert without[1].argmax() != 3 or without[1, 3] == pytest.approx(0.2)
    assert shared[1, 3] > 0.7 and shared[2, 3] == pytest.approx(0.2)


def test_odd_rows(odd, clashing):
    found = personal_data_digest(personal_data(clashing(odd)))
    assert found.count() == odd.count() and {r["spans"] for r in found.collect()} == {""}
    assert personal_data(odd.limit(0)).count() == 0


def test_digest_and_replacing(documents):
    rows = [(i, t + f" {i}", "s") for i, t in enumerate(TEXTS)] + [(900, None, "s")]
    found = personal_data(documents(rows), replace=True).collect()
    digest = {r["doc_id"]: r for r in personal_data_digest(personal_data(documents(rows))).collect()}
    for r in found:
        text = dict((i, t) for i, t, _ in rows)[r["doc_id"]] or ""
        base = [(s["start"], KINDS.index(s["kind"]), s["end"]) for s in r["spans"] if s["base"]]
        assert base == brute(text)
        assert digest[r["doc_id"]]["n_phone"] == sum(k == 3 for _, k, _ in base)
        assert not any(text[a:b] in r["clean"] for a, _, b in base)


@pytest.mark.parametrize(
    "one, other, same",
    [
        ("843-555-7672", "843.555.7672,", True), ("(843)555-7672", "tel:8435557672", True), ("A.b@x.org", "<mailto:a.b@X.org>", True),
        ("843-555-7672", "843-555-7673", False), ("192.168.11.1", "192.168.1.11", False), ("12345.678", "1234567.8", False), ("12-3", "123", False),
    ],
)
def test_repeats_in_another_layout_are_joined(one, other, same):
    keys = [privacy._features(t)[1] for t in (one, other)]
    assert (keys[0] == keys[1]) == same


@pytest.mark.parametrize("token", ["QUJD" * 250_000 + "9", "a" * 1_000_000 + ";9@x.org", "data:image/png;base64," + "iVBOR9" * 170_000])
def test_a_long_token_among_many_small_ones(token):
    import time
    import tracemalloc

    text = " ".join([*(f"w{i % 400} t{i}" for i in range(5_000)), token, "call +1 (843) 555-7672 today"])
    field = fit_field(TEXTS)
    begun = time.perf_counter()
    tracemalloc.start()
    spans = all_spans(text, base_spans(text), field)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert any(KINDS[k] == "phone" and text[a:b] == "+1 (843) 555-7672" for a, k, b in spans)
    assert peak < 300 << 20 and time.perf_counter() - begun < 60


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab.-@;:=<é ", max_size=30))
def test_the_form_of_an_address(core):
    found = re.search(r"[^\s@:;,<>()\[\]\"'=]+@[\w-]+(?:\.[\w-]+)*", core)
    assert privacy._form(core, []) == (found[0] if found else core)
