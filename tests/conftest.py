import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from tickloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tickloom-tests")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    """A fresh folder as text, with a helper to write files into it."""

    class Folder(type(str())):
        def put(self, name, content):
            target = tmp_path / name
            target.parent.mkdir(parents=True, exist_ok=True)
            target.write_bytes(content if isinstance(content, bytes) else content.encode())
            return str(target)

    return Folder(tmp_path)
