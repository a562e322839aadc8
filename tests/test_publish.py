"""Publication with rollback, and the cache of stores."""

import hashlib

import pytest

from plinth.sources import files, publish
from plinth.sources.store import Store, StoreError, from_records

LEVEL = {"id": "l1", "name": "Base", "elevation": 0, "unit": "mm", "provenance": "given", "confidence": 1.0}


def staged(spark, path, name="Base"):
    from_records(spark, {"levels": [LEVEL | {"name": name}]}).write(path)
    return path


def latest(spark, root):
    return Store.open(spark, f"{root}/latest").table("levels").first().name


def test_publication_swaps_whole_stores(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/root"
    assert publish.publish(spark, staged(spark, f"file://{tmp_path}/a", "One"), root, "2024-01-01") == [] and latest(spark, root) == "One"
    assert publish.publish(spark, staged(spark, f"file://{tmp_path}/b", "Two"), root, "2024-03-01", keep_days=30) == ["2024-01-01"] and latest(spark, root) == "Two"
    assert files.names(spark, f"{root}/archive") == ["2024-03-01"] and not files.exists(spark, f"{root}/.previous")
    with pytest.raises(StoreError, match="not_null_name"):
        publish.publish(spark, staged(spark, f"file://{tmp_path}/c", None), root, "2024-03-02")
    opened, real = [], Store.open

    def fails_at_last(s, path):
        opened.append(path)
        if path.endswith("/latest"):
            raise OSError("disk gone")
        return real(s, path)

    monkeypatch.setattr(publish.Store, "open", fails_at_last)
    with pytest.raises(OSError, match="disk gone"):
        publish.publish(spark, staged(spark, f"file://{tmp_path}/d", "Four"), root, "2024-03-03")
    monkeypatch.setattr(publish.Store, "open", real)
    assert latest(spark, root) == "Two"  # put back
    files.rename(spark, f"{root}/latest", f"{root}/.previous")
    assert publish.recover(spark, root) and latest(spark, root) == "Two" and not publish.recover(spark, root)
    assert files.claim(spark, f"{root}/.lock") and not files.claim(spark, f"{root}/.lock")
    with pytest.raises(StoreError, match="another publication"):
        publish.publish(spark, f"file://{tmp_path}/d", root, "2024-03-04")


class Killed(BaseException):
    """The process is gone: from here on nothing more happens."""


def test_a_publication_killed_at_any_step_is_made_good_by_the_next(spark, tmp_path, monkeypatch):
    writes = ("rename", "move", "copy", "delete", "replace")
    real = {n: getattr(files, n) for n in writes}
    for step in range(1, 40):
        root, left = f"file://{tmp_path}/root{step}", [step]
        publish.publish(spark, staged(spark, f"file://{tmp_path}/old{step}", "Old"), root, "2024-01-01")
        new = staged(spark, f"file://{tmp_path}/new{step}", "New")

        def dies(name, left=left):
            def run(*args):
                left[0] -= 1
                if left[0] < 0:
                    raise Killed
                return real[name](*args)

            return run

        for n in writes:
            monkeypatch.setattr(files, n, dies(n))
        try:
            publish.publish(spark, new, root, "2024-01-02")
        except Killed:
            pass
        for n in writes:
            monkeypatch.setattr(files, n, real[n])
        assert publish.open_latest(spark, root).table("levels").first().name in ("Old", "New")
        if left[0] >= 0:
            break  # it came to its end
        if files.exists(spark, f"{root}/.lock"):
            with pytest.raises(StoreError, match="another publication"):
                publish.publish(spark, new, root, "2024-01-02")
        again = new if files.exists(spark, new) else staged(spark, f"file://{tmp_path}/again{step}", "New")
        publish.publish(spark, again, root, "2024-01-02", stale_seconds=0)
        assert latest(spark, root) == "New" and files.names(spark, f"{root}/archive") == ["2024-01-01", "2024-01-02"]
        assert not [n for n in files.names(spark, root) if n not in ("archive", "latest")]
    assert step > 8


def test_an_overtaken_owner_stops(spark, tmp_path):
    one = publish.Lease(spark, f"file://{tmp_path}/r", 3600)
    with pytest.raises(StoreError, match="another publication is running"):
        publish.Lease(spark, f"file://{tmp_path}/r", 3600)
    one.renew()
    two = publish.Lease(spark, f"file://{tmp_path}/r", 0)
    with pytest.raises(StoreError, match="took over"):
        one.renew()
    one.release()
    two.renew()
    two.release()
    assert files.names(spark, f"file://{tmp_path}/r") == []


def test_cache_and_digests(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return from_records(spark, {"levels": [LEVEL]})

    for _ in range(2):
        assert publish.cached(spark, f"file://{tmp_path}/cache", "key", build).table("levels").count() == 1
    assert len(built) == 1
    (tmp_path / "x.txt").write_text("x")
    assert publish.digests(spark, f"file://{tmp_path}", ["x.txt"]) == {"x.txt": hashlib.sha256(b"x").hexdigest()}
    with pytest.raises(StoreError, match="missing files: y"):
        publish.digests(spark, f"file://{tmp_path}", ["x.txt", "y"])
