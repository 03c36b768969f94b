import pytest

from quillon import config


def test_file_and_environment(tmp_path):
    f = tmp_path / "c.toml"
    f.write_text('[library]\nname = "L"\nroot = "/a"\n[spark]\n"spark.sql.adaptive.enabled" = true\n[providers.fred]\nfolder = "/in"\n[[subscriptions]]\nname = "rates"\nprovider = "fred"\ndataset = "Economic Indicators"\ndata_types = ["economic-indicator"]\n')
    c = config.load(f, {"QUILLON_LIBRARY_ROOT": "s3://b", "QUILLON_PROVIDERS_TIINGO_KEY": "k", "QUILLON_SPARK_SQL__SHUFFLE__PARTITIONS": "7", "HOME": "/h"})
    assert c.library == {"name": "L", "root": "s3://b"} and c.providers == {"fred": {"folder": "/in"}, "tiingo": {"key": "k"}}
    assert c.spark == {"spark.sql.adaptive.enabled": "true", "spark.sql.shuffle.partitions": "7"}
    assert c.subscriptions[0].subscription_id == "" and c.subscriptions[0].data_types == ("economic-indicator",)


def test_no_file_and_unknown_tables(tmp_path):
    assert config.load(tmp_path / "none.toml", {}) == config.Config()
    bad = tmp_path / "b.toml"
    bad.write_text("[nothing]\nx = 1\n")
    with pytest.raises(ValueError, match="nothing"):
        config.load(bad, {})
