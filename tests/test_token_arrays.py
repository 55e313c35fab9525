import math

import pytest

from chatsift.functions import token_arrays as ta

IDS = "ids array<int>"
VEC = "s array<double>, t array<double>"


def test_clip_left_and_pad(one):
    assert one(ta.clip_left("ids", 3), IDS, ([1, 2, 3, 4, 5],)) == [3, 4, 5]
    assert one(ta.pad_to("ids", 4, 0, "left"), IDS, ([7, 8],)) == [0, 0, 7, 8]
    assert one(ta.pad_to("ids", 4, 0, "right"), IDS, ([7, 8],)) == [7, 8, 0, 0]
    assert one(ta.pad_mask("ids", 4, "left"), IDS, ([7, 8],)) == [0, 0, 1, 1]


def test_eos_clip(one):
    assert one(ta.eos_clip("ids", 9), IDS, ([1, 9, 2, 9],)) == [1, 9]
    assert one(ta.eos_clip("ids", 9), IDS, ([1, 2],)) == [1, 2]


def test_is_truncated(one):
    assert one(ta.is_truncated("ids", 9, 0), IDS, ([1, 9],)) is False
    assert one(ta.is_truncated("ids", 9, 0), IDS, ([1, 0],)) is False
    assert one(ta.is_truncated("ids", 9, 0), IDS, ([1, 2],)) is True


def _py_log_softmax(x):
    m = max(x)
    lse = m + math.log(sum(math.exp(v - m) for v in x))
    return [v - lse for v in x]


def test_log_softmax_and_entropy(one):
    x = [1.0, 2.0, 3.0, -1.0]
    got = one(ta.log_softmax("s", 1.0), VEC, (x, x))
    assert got == pytest.approx(_py_log_softmax(x))
    ent = one(ta.entropy_from_logps(ta.log_softmax("s")), VEC, (x, x))
    lp = _py_log_softmax(x)
    assert ent == pytest.approx(-sum(math.exp(v) * v for v in lp))


@pytest.mark.parametrize("alpha", [0.0, 0.3, 0.5, 1.0])
def test_divergence_zero_on_equal(one, alpha):
    x = [0.5, -1.0, 2.0]
    v = one(ta.generalized_jsd(ta.log_softmax("s"), ta.log_softmax("t"), alpha), VEC, (x, x))
    assert abs(v) < 1e-12


def test_divergence_alpha_0_and_1_differ(one):
    s, t = [3.0, 0.0, 0.0], [0.0, 0.0, 1.0]
    f = one(ta.generalized_jsd(ta.log_softmax("s"), ta.log_softmax("t"), 0.0), VEC, (s, t))
    r = one(ta.generalized_jsd(ta.log_softmax("s"), ta.log_softmax("t"), 1.0), VEC, (s, t))
    ls, lt = _py_log_softmax(s), _py_log_softmax(t)
    assert f == pytest.approx(sum(math.exp(b) * (b - a) for a, b in zip(ls, lt)))
    assert r == pytest.approx(sum(math.exp(a) * (a - b) for a, b in zip(ls, lt)))
    assert f != pytest.approx(r)
