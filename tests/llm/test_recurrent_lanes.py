"""A trainer whose documents run out computes only the lanes that still have one."""

import numpy as np
import pytest

from meterflow.llm import recurrent_lm as lm


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(lm, "STATE", 6)
    monkeypatch.setattr(lm, "CLASSES", 4)
    monkeypatch.setattr(lm, "BUCKETS", 3)
    monkeypatch.setattr(lm, "TRAIN_LANES", 4)
    monkeypatch.setattr(lm, "TRAIN_STEPS", 3)
    words = [(f"w{k}", 50 - k) for k in range(20)]
    inside = np.zeros(3)
    for w, n in words:
        inside[lm.bucket(w)] += n
    s = lm.Symbols(words, inside + 10, 30)
    w = {k: v.astype(np.float64) for k, v in lm.new_weights(s).items()}
    return s, w


def test_a_draining_trainer_computes_only_lanes_with_documents(small, monkeypatch):
    s, w = small
    widths, full = [], lm.window_gradients

    def counted(w_, s_, x, y, fresh, state, live):
        widths.append(x.shape[1])
        assert live.any(0).all()
        got, loss, after = full(w_, s_, x, y, fresh, state, live)
        # the window with one more lane that has no document gives the same gradients, loss and states
        steps, idle = x.shape[0], np.zeros((x.shape[0], 1), bool)
        more, loss_, after_ = full(
            w_, s_, np.hstack([x, np.full((steps, 1), s_.size)]), np.hstack([y, np.zeros((steps, 1), np.int64)]),
            np.hstack([fresh, idle]), np.vstack([state, np.ones((1, lm.STATE), np.float32)]), np.hstack([live, idle]))
        assert loss_ == pytest.approx(loss)
        assert np.allclose(after_[:-1], after)
        for k in got:
            if k == "x":
                assert set(more[k][0]) >= set(got[k][0])
                assert np.allclose(more[k][1][np.isin(more[k][0], got[k][0])], got[k][1])
            else:
                assert np.allclose(more[k], got[k], atol=1e-12)
        return got, loss, after

    monkeypatch.setattr(lm, "window_gradients", counted)
    trainer = lm.Trainer(w, s)
    rng = np.random.default_rng(1)
    for n in (30, 2, 2, 2, 2, 2):  # the long document keeps one lane busy after the others ran out
        trainer.feed(rng.integers(0, s.size - 1, n).astype(np.int32))
    trainer.finish()
    assert trainer.tokens == 40
    assert widths[-1] == 1  # every window had all lanes before
