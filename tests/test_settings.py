import json

import pytest

from sluice.plans.pipeline import Cleaning
from sluice.sources.settings import Sections


def written(tmp_path, given):
    path = tmp_path / "s.json"
    path.write_text(json.dumps(given))
    return str(path)


def test_defaults_file_and_environment_in_that_order(tmp_path):
    path = written(tmp_path, {"crawler": {"timeout": 5, "max_workers": 2}, "processor": {"min_resolution": [10, 20]}, "api_sources": {"pexels": {"enabled": False}}, "logging": {"level": "x"}, "proxy": {"unknown": 1}})
    made = Sections.load(path, {"SLUICE_MAX_WORKERS": "9", "SLUICE_PEXELS_API_KEY": "k", "SLUICE_MODEL": "", "MY_KEY": "m"}, variables={"MY_KEY": ("synthesizer", "api_key")})
    assert (made.crawler.timeout, made.crawler.max_workers, made.crawler.retry_count) == (5, 9, 3)
    assert made.processor.min_resolution == (10, 20) and made.synthesizer.api_key == "m" and made.synthesizer.model is None
    pexels = made.api_sources.pexels
    assert (pexels.enabled, pexels.api_key, pexels.rate_limit, pexels.priority) == (False, "k", 200, 2)
    assert Sections.load(str(tmp_path / "none.json"), {}) == Sections() == Sections.load(written(tmp_path, {}), {})
    assert Sections.load(written(tmp_path, {"api_sources": {"flickr": {}}}), {"SLUICE_UNSPLASH_API_KEY": "u"}).api_sources.unsplash.api_key == "u"


@pytest.mark.parametrize("given", [{"crawler": {"timeout": "soon"}}, {"crawler": {"timeout": 1.5}}, {"crawler": []}, {"proxy": {"enabled": 1}}, {"processor": {"min_resolution": [1]}}, {"crawler": {"max_workers": None}}, {"crawler": {"user_agents": "a"}}])
def test_what_does_not_fit_is_named(tmp_path, given):
    section = next(iter(given))
    with pytest.raises(ValueError, match=section):
        Sections.load(written(tmp_path, given), {})


def test_what_is_saved_is_loaded(tmp_path):
    made = Sections()
    made.proxy.proxy_list, made.data.raw_dir = ["http://p"], str(tmp_path / "data" / "raw")
    made.save(str(tmp_path / "sub" / "s.json"))
    assert Sections.load(str(tmp_path / "sub" / "s.json"), {}) == made


def test_what_settings_are_for(spark, tmp_path):
    made = Sections()
    made.processor.blur_threshold, made.validator.enabled, made.api_sources.pexels.api_key = 50.0, False, "k"
    assert Cleaning.of(made) == Cleaning(validate=False, sharpness=50.0, hamming=8, scene_change=30.0)
    rows = {r["source"]: r for r in made.source_limits(spark).collect()}
    assert len(rows) == 5 and rows["pexels"]["has_key"] and not rows["flickr"]["has_key"] and rows["nasa"]["rate_limit"] == 0
