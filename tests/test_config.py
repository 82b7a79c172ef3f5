"""The shared checkpoint root comes from the session; a private one only when unset."""

import skuflow.config as cfg


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, conf=None, ckpt=None):
        self.conf, self.ckpt, self.set_to = conf or {}, ckpt, None

    def getConf(self):
        return _Conf(self.conf)

    def getCheckpointDir(self):
        return self.ckpt

    def setCheckpointDir(self, d):
        self.set_to = d


class _Session:
    def __init__(self, conf=None, ctx=None):
        self.conf, self.sparkContext = _Conf(conf or {}), ctx or _Context()


def test_session_setting_wins_and_nothing_is_set(monkeypatch):
    monkeypatch.setattr(cfg, "_FALLBACK_ROOT", None)
    ctx = _Context()
    s = _Session({"spark.checkpoint.dir": "hdfs://nn/shared/ckpt/"}, ctx)
    assert cfg.checkpoint_root(s) == "hdfs://nn/shared/ckpt"
    assert ctx.set_to is None
    assert cfg.scratch_path(s, "q").startswith("hdfs://nn/shared/ckpt/skuflow/q-")


def test_context_dir_used_when_conf_unset(monkeypatch):
    monkeypatch.setattr(cfg, "_FALLBACK_ROOT", None)
    ctx = _Context(ckpt="s3a://bucket/ckpt/abc")
    assert cfg.checkpoint_root(_Session({}, ctx)) == "s3a://bucket/ckpt/abc"
    assert ctx.set_to is None


def test_private_folder_only_when_nothing_is_set(monkeypatch):
    monkeypatch.setattr(cfg, "_FALLBACK_ROOT", None)
    ctx = _Context()
    root = cfg.checkpoint_root(_Session({}, ctx))
    assert ctx.set_to == root and "skuflow-ckpt-" in root
    assert cfg.checkpoint_root(_Session({}, _Context())) == root  # created once


def test_no_private_folder_off_a_local_master(monkeypatch):
    import pytest

    from skuflow import config

    class Conf:
        def get(self, key, default=None):
            return "spark://host:7077" if key == "spark.master" else default

    class Session:
        conf = Conf()

        @property
        def sparkContext(self):
            raise RuntimeError("no local context")

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        config.checkpoint_root(Session())
