import pytest

from siltworks.functions import fixed
from siltworks.plans import params


def test_layers_win_in_order():
    assert params.merge()["min_turns"] == 0
    assert params.merge(theme="coding")["min_turns"] == 3
    assert params.merge(theme="coding", override={"min_user_turns": 1})["min_turns"] == 1
    assert params.merge(theme="coding", override={"min_user_turns": 1}, min_turns=5)["min_turns"] == 5


def test_clearing():
    p = params.merge(override={"sig_ratio_min": None, "dedup_threshold": None})
    assert p["sig_ratio_min"] is None and p["dedup_threshold"] is None
    with pytest.raises(params.ConfigError):
        params.merge(override={"min_user_turns": None})
    with pytest.raises(params.ConfigError):
        params.merge(override={"topic_keywords": None})


def test_option_order():
    assert params.merge(dedup_threshold=0.9, no_dedup=True)["dedup_threshold"] is None
    assert params.merge(sig_ratio_min=0.2, no_signature=True)["sig_ratio_min"] == 0.2
    assert params.merge(sig_ratio_min=0.0)["sig_ratio_min"] == 0.0


def test_empty_lists_are_absent():
    p = params.merge(theme="translation", override={"exclude_keywords": []}, topic_keywords=[])
    assert "topic_keywords" not in p and "exclude_keywords" not in p


def test_unknown_and_older_shapes():
    for bad in ({"min_turn": 1}, {"policy": {}}):
        with pytest.raises(params.ConfigError):
            params.merge(override=bad)
    for theme in ({"keywords": [], "policy": {}}, {"keywords": [], "exclude_keywords": []}, {"keywords": [], "override": 3}):
        with pytest.raises(params.ConfigError):
            params.merge(theme="x", themes={"x": theme})
    with pytest.raises(params.ConfigError):
        params.merge(theme="nothing")


def test_direction():
    entries = params.check_direction(fixed.DIRECTION_NOCODE)
    assert [e["theme"] for e in entries] == ["role-play", "writing", "planning", "report-analysis"]
    assert all(e["override"]["min_user_turns"] == 5 for e in entries)
    for bad in ({"themes": []}, {"themes": [{"theme": "writing"}, {"theme": "writing"}]}, {"themes": [{"theme": 1}]}, {"themes": [{"theme": "writing"}], "extra": 1}, {"themes": [{"theme": "missing"}]}, {"themes": [{"theme": "writing", "override": []}]}):
        with pytest.raises(params.ConfigError):
            params.check_direction(bad)


def test_load_object(tmp_path):
    (tmp_path / "a.json").write_text("[1]")
    (tmp_path / "b.json").write_text("{")
    for name in ("a.json", "b.json", "c.json"):
        with pytest.raises(params.ConfigError):
            params.load_object(tmp_path / name)
