import math

import pytest

from tablewright.functions.tails import f_upper, t_quantile, t_two_sided

SIZES = [10.0 ** e for e in range(3, 14)]


def t_point(z, df):
    """Expansion of the t quantile in 1/df."""
    return (z + (z**3 + z) / 4 / df + (5 * z**5 + 16 * z**3 + 3 * z) / 96 / df**2
            + (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384 / df**3)


@pytest.mark.parametrize("df", SIZES)
def test_tails_at_any_row_count(df):
    assert t_quantile(0.975, df) == pytest.approx(t_point(1.959963984540054, df), rel=1e-9)
    assert t_quantile(0.01, df) == pytest.approx(-t_point(2.3263478740408408, df), rel=1e-9)
    # Equal degrees of freedom: F and 1 / F have one distribution.
    assert f_upper(1.0, df, df) == pytest.approx(0.5, abs=1e-12)
    near = 1 + 2 / math.sqrt(df)
    assert f_upper(near, df, df) + f_upper(1 / near, df, df) == pytest.approx(1.0, abs=1e-10)
    # Two numerator degrees of freedom have a closed form.
    for f in (0.01, 1.0, 5.0, 40.0):
        assert f_upper(f, 2, df) == pytest.approx(math.exp(-df / 2 * math.log1p(2 * f / df)), rel=1e-9)
        assert t_two_sided(math.sqrt(f), df) == pytest.approx(f_upper(f, 1, df), rel=1e-12)


def test_normal_and_chi_square_limits():
    for t in (0.1, 1.0, 3.0, 8.0):
        assert t_two_sided(t, 1e13) == pytest.approx(math.erfc(t / math.sqrt(2)), rel=1e-9)
    # Four numerator degrees: the chi-square tail is exp(-x / 2) (1 + x / 2).
    for f in (0.5, 2.0, 10.0):
        assert f_upper(f, 4, 1e13) == pytest.approx(math.exp(-2 * f) * (1 + 2 * f), rel=1e-9)


def test_few_degrees_of_freedom():
    for t in (1e-9, 0.01, 0.5, 1.0, 3.0, 50.0, 1e6):
        assert t_two_sided(t, 1) == pytest.approx(2 * math.atan2(1, t) / math.pi, rel=1e-12)
        assert t_two_sided(t, 2) == pytest.approx((2 / (2 + t * t)) / (1 + t / math.sqrt(2 + t * t)), rel=1e-12)
        assert f_upper(t, 2, 7) == pytest.approx((1 + 2 * t / 7) ** -3.5, rel=1e-12)
    assert f_upper(2.0, 5, 3) == pytest.approx(1 - f_upper(0.5, 3, 5), rel=1e-12)
    assert t_two_sided(0.0, 5) == 1.0 and t_two_sided(math.inf, 5) == 0.0 and f_upper(-1.0, 2, 2) == 1.0
    assert math.isnan(t_two_sided(1.0, 0)) and math.isnan(f_upper(math.nan, 1, 1)) and math.isnan(t_quantile(1.0, 3))
