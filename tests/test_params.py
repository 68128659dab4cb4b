import pytest

from sessionloom import params as P


@pytest.mark.parametrize(
    "value, ratio",
    [
        (None, 0.01),
        ("abc", 0.01),
        ("0", 0.01),
        ("-0.05", 0.01),
        ("0.2", 0.01),
        ("NaN", 0.01),
        ("0_0.05", 0.01),
        ("0.1", 0.1),
        ("0.05", 0.05),
        (" 5e-2 ", 0.05),
        ("0.05d", 0.05),
        (0.05, 0.05),
    ],
)
def test_ratio(value, ratio):
    assert P.sample_ratio({} if value is None else {P.SESSION_RATIO: value}) == ratio


def test_sample_type_needs_the_exact_word():
    assert P.sample_type({}) == "bernoulli"
    assert P.sample_type({P.SAMPLE_TYPE: "poisson"}) == "poisson"
    assert P.sample_type({P.SAMPLE_TYPE: "Poisson"}) == "bernoulli"
    assert P.sample_type({P.SAMPLE_TYPE: " poisson"}) == "bernoulli"


def test_param_is_untrimmed_and_blank_counts_as_missing():
    assert P.get_param({"a": " x "}, "a") == " x "
    assert P.get_param({"a": " \t\x00"}, "a") is None
    assert P.get_param({"a": None}, "a") is None
    assert P.get_param({"a": 5}, "a") == "5"
    assert P.get_param({"a": True}, "a") == "true"
    assert P.get_list({"a": "x, y,,"}, "a") == ["x", " y"]


def test_task_errors():
    with pytest.raises(ValueError, match="not a task id"):
        P.task_id_from_args([])
    with pytest.raises(ValueError, match="not a task id"):
        P.task_id_from_args(["7a"])
    assert P.task_id_from_args(["7", "ignored"]) == 7
    for text in (None, "", "{}", "null"):
        with pytest.raises(ValueError, match="empty parameters"):
            P.parse_task_param(text)
    with pytest.raises(ValueError, match="not JSON"):
        P.parse_task_param("{")
    with pytest.raises(ValueError, match="not a JSON object"):
        P.parse_task_param("[1]")
    assert P.parse_task_param('{"sex":"male"}') == {"sex": "male"}
