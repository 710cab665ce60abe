from datetime import date, datetime

import pytest

from tillpanel.functions.cutoffs import cutoff_date


@pytest.mark.parametrize(
    "value", ["2011-04-01", date(2011, 4, 1), datetime(2011, 4, 1, 23, 59)]
)
def test_accepted_forms(value):
    parsed = cutoff_date(value)
    assert parsed == date(2011, 4, 1)
    assert type(parsed) is date


def test_malformed_text_is_rejected():
    with pytest.raises(ValueError):
        cutoff_date("01/04/2011")


def test_other_types_are_rejected():
    with pytest.raises(TypeError):
        cutoff_date(20110401)
