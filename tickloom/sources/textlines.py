"""Small helpers that run inside tasks: whole lines out of a byte stream."""

from __future__ import annotations

from collections.abc import Iterator
from typing import BinaryIO

CHUNK = 1 << 20


def text_blocks(stream: BinaryIO, chunk: int = CHUNK) -> Iterator[str]:
    """A byte stream as texts of whole lines, about ``chunk`` bytes each.

    Lines in a block are parted by LF; the last one has no end. Ends of line in the
    stream are LF, CR LF or CR, as in Spark's text reader. Only the current chunk
    and an unfinished line are in memory.
    """
    rest = b""
    while data := stream.read(chunk):
        data = rest + data
        # A trailing CR may be the first half of CR LF, so it waits for more.
        held = b"\r" if data.endswith(b"\r") else b""
        data = data[: len(data) - len(held)].replace(b"\r\n", b"\n").replace(b"\r", b"\n")
        whole, newline, tail = data.rpartition(b"\n")
        rest = tail + held
        if newline:
            yield whole.decode("utf-8", errors="replace")
    if rest:
        yield rest.removesuffix(b"\r").decode("utf-8", errors="replace")


def first_line(stream: BinaryIO) -> str | None:
    """First line that is not blank, without a byte-order mark."""
    for block in text_blocks(stream, 64 << 10):
        for line in block.split("\n"):
            if line.strip():
                return line.removeprefix("\ufeff")
    return None


def after_first_line(blocks: Iterator[str]) -> Iterator[str]:
    """The blocks without the first line that is not blank, and blank ones before it."""
    seen = False
    for block in blocks:
        while not seen and block:
            line, _, block = block.partition("\n")
            seen = bool(line.strip())
        if block:
            yield block
