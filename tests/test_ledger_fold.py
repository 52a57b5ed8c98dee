"""The vectorized ledger fold equals the event-by-event step function."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tavolo.operators.ledger import fold_run, step

event = st.tuples(st.booleans(), st.integers(1, 9), st.one_of(st.none(), st.integers(1, 5)),
                  st.one_of(st.none(), st.integers(1, 5)))


def scalar(events):
    state, rows = None, []
    for i, (add, q, p, s) in enumerate(events):
        state, ok, reason, upp, usp = step(state, "add" if add else "sale", q, p, s, i)
        rows.append((ok, reason, upp, usp, state["stock"] if state else 0,
                     state["pp"] if state else None, state["first_seq"] if state else None))
    return rows


def vector(events, vector_min, window):
    add = np.array([e[0] for e in events], dtype=bool)
    q = np.array([e[1] for e in events], dtype=np.int64)
    pn = np.array([e[2] is None for e in events], dtype=bool)
    sn = np.array([e[3] is None for e in events], dtype=bool)
    p = np.array([e[2] or 0 for e in events], dtype=np.int64)
    s = np.array([e[3] or 0 for e in events], dtype=np.int64)
    seq = np.arange(len(events), dtype=np.int64)
    _, o = fold_run(None, add, q, p, s, seq, pn, sn, vector_min=vector_min, window=window)
    rows = []
    for i in range(len(events)):
        ok = bool(o["accepted"][i])
        st_ok = bool(o["_state_ok"][i])
        rows.append((ok, o["reason"][i], int(o["pp_c"][i]) if o["_upp_ok"][i] else None,
                     int(o["sp_c"][i]) if o["_usp_ok"][i] else None,
                     int(o["stock_c"][i]) if st_ok else 0, int(o["spp_c"][i]) if st_ok else None,
                     int(o["first_seq"][i]) if st_ok else None))
    return rows


@settings(max_examples=300, deadline=None)
@given(st.lists(event, min_size=0, max_size=200), st.integers(1, 50))
def test_vectorized_equals_scalar(events, window):
    assert vector(events, 0, window) == scalar(events)
    assert vector(events, 10**9, window) == scalar(events)


def test_stock_never_negative_on_long_run():
    rng = np.random.default_rng(0)
    events = [(bool(rng.random() < 0.4), int(rng.integers(1, 20)), 3, 6) for _ in range(20000)]
    rows = vector(events, 0, 8192)
    assert rows == scalar(events)
    assert min(r[4] for r in rows) >= 0
