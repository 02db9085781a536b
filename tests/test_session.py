"""Loading without files, and who sets session values."""

import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

LOAD = """
import builtins, glob, sys, zipfile
glob.glob = lambda *a, **k: []
def refuse(*a, **k): raise AssertionError("no archive is read at import")
zipfile.ZipFile = refuse
sys.path.insert(0, {repo!r})
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()))
"""


def test_queries_load_in_a_fresh_process():
    out = subprocess.run([sys.executable, "-c", LOAD.format(repo=REPO)], capture_output=True, text=True, cwd="/tmp")
    assert out.returncode == 0, out.stderr
    n, n_sql = map(int, out.stdout.split())
    assert n >= 46 and n_sql >= 45


def test_entry_without_the_optional_part(tmp_path):
    code = f"""
import sys
class Hide:
    def find_spec(self, name, path=None, target=None):
        if name.startswith(("tagloom.llm", "corpus_pipeline")):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Hide())
sys.path.insert(0, {REPO!r})
import __spark_entry__ as e
assert e.llm is None and "pipeline" not in e.queries() and len(e.queries()) >= 46
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path)
    assert out.returncode == 0, out.stderr


class _Context:
    master = "spark://host:7077"

    def getConf(self):
        return {}

    def getCheckpointDir(self):
        return None


class _Session:
    sparkContext = _Context()
    conf = {}


def test_cluster_without_a_shared_folder_is_refused():
    from tagloom.session import checkpoint_dir
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Session())


def test_submitted_settings_win(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {REPO!r})
from tagloom.session import get_session
s = get_session("local[1]", 8)
print(s.conf.get("spark.sql.session.timeZone"), s.conf.get("spark.sql.adaptive.enabled"))
"""
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--conf spark.sql.session.timeZone=Asia/Tokyo pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path, env=env)
    assert out.stdout.split() == ["Asia/Tokyo", "true"], out.stderr[-500:]


def test_local_session_without_the_setting(tmp_path):
    """Without spark.checkpoint.dir a private folder serves, and goes at the end."""
    code = f"""
import sys
sys.path.insert(0, {REPO!r})
import __spark_entry__ as e
from tagloom.session import checkpoint_dir, get_session
s = get_session("local[2]", 4)
assert s.sparkContext.getConf().get("spark.checkpoint.dir") is None
first = checkpoint_dir(s)
assert first == checkpoint_dir(s) == s.sparkContext.getCheckpointDir()
assert e.entry(s).count() > 0
print(first)
"""
    (tmp_path / "conf").mkdir()
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path / "conf"), "TAGLOOM_DRIVER_MEMORY": "2g"}
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path, env=env)
    assert out.returncode == 0, out.stderr[-2000:]
    assert not os.path.exists(out.stdout.strip().removeprefix("file:"))
