import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import documents, empty_documents, odd_documents
from keyweave.llm import pii_crf as c


def brute(text):
    out = [(m.start(), "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m.group().split("."))]
    digits = lambda m: len(re.sub("[^0-9]", "", m.group()))
    out += [(m.start(), "card", m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 14 <= digits(m) <= 19 and c.luhn(m.group())]
    out += [(m.start(), "phone", m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= digits(m) <= 15]
    return c.in_order(out)


@pytest.fixture(scope="module")
def field():
    return c.train(c.labelled_table())


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("ab.@-+ 0123456789()\néA"), max_size=60))
def test_base_spans_as_by_search(text):
    assert c.base_spans(text) == brute(text)


def test_known_spans(spark, field):
    text = "é mail me: jo.do+x@a-b.example.com, 10.0.0.256 or 10.0.0.25. Card 4111 1111 1111 1111 +1 (988) 555-2485"
    (r,) = c.personal_data(documents(spark, [text]), field).collect()
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 1)
    base = c.written(c.base_spans(text))
    assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert set(base.split(",")) <= set(r.spans.split(","))


def test_field_adds_spans_and_leaves_numbers_alone(field):
    def added(text):
        return [(k, text[s:e]) for s, k, e in c.add_field_spans([text], [c.base_spans(text)], field)[0] if (s, k, e) not in c.base_spans(text)]

    assert added("please call (415) 555-1234 today") == [("phone", "(415) 555-1234")]
    for text in ("Version 2.0.", "password=25a0bc4376e17c8019", "in 2024, page 3", "at 12:30", '"0641917ea4e9feb9cda83477b57ac2654884f485"'):
        assert added(text) == []


def test_held_out_accuracy(field):
    hits = found = wanted = 0
    for text, spans in c.labelled_table(200, seed=99):
        rs = c.runs(text)
        tags = field.decode([c.run_features(text, r) for r in rs])
        got = {(s, e, k) for r, t in zip(rs, tags) for s, k, e in c.field_spans(text, r, t)}
        gold = {(s, e, k) for s, e, k in spans}
        hits, found, wanted = hits + len(got & gold), found + len(got), wanted + len(gold)
    assert hits > 0.9 * found and hits > 0.9 * wanted


def test_viterbi_is_the_best_path(field):
    from itertools import product

    import numpy as np

    run = c.run_features("x +1 (988) 555-2485 y", [(2, 4), (5, 10), (11, 19)])
    scores = np.array([field.emit[[field.names[f] for f in t if f in field.names]].sum(axis=0) for t in run])
    move, start = field.move + c.FORBIDDEN, field.start + c.FORBIDDEN_START
    value = lambda p: start[p[0]] + scores[0, p[0]] + sum(move[a, b] + scores[i + 1, b] for i, (a, b) in enumerate(zip(p, p[1:])))
    assert tuple(field.decode([run])[0]) == max(product(range(len(c.TAGS)), repeat=3), key=value)


def test_odd_rows(spark, field):
    out = c.personal_data(odd_documents(spark), field)
    assert out.count() == odd_documents(spark).count() and out.where("spans <> ''").count() == 0
    assert c.personal_data(empty_documents(spark), field).isEmpty()


@pytest.mark.parametrize("unit", ["0", "@", "+", "a@", "1.", "1 ", "a."])
def test_long_runs_take_no_quadratic_time(field, unit):
    text = unit * (100_000 // len(unit))
    c.add_field_spans([text], [c.base_spans(text)], field)
