import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from civicspark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def raw(tmp_path):
    """Writes pretty-printed envelopes the way the crawler leaves them."""

    class Raw:
        path = str(tmp_path / "raw")
        written = 0

        def put(self, entity, name, dados, endpoint=None, count=None, text=None):
            folder = tmp_path / "raw" / entity
            folder.mkdir(parents=True, exist_ok=True)
            meta = {"endpoint": endpoint or f"/{entity}", "params": {}, "fetched_at": name,
                    "count": len(dados) if count is None and isinstance(dados, list) else count, "source": "x"}
            body = text if text is not None else json.dumps({"_meta": meta, "dados": dados}, ensure_ascii=False, indent=2)
            (folder / f"{name}.json").write_text(body, encoding="utf-8")
            # streams read files in order of modification
            self.written += 1
            os.utime(folder / f"{name}.json", (1.7e9 + self.written, 1.7e9 + self.written))

    return Raw()


def rows(df, *order):
    """Collected rows as dictionaries, sorted by the given columns."""
    out = [r.asDict(recursive=True) for r in df.collect()]
    return sorted(out, key=lambda r: tuple(repr(r[c]) for c in order)) if order else out
