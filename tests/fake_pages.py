"""A page reader for tests: pages are lines of a file; what is read is noted beside it."""

import os


class LineReader:
    def _note(self, source, what):
        folder = os.environ.get("FAKE_PAGES_NOTES")
        if folder:
            with open(f"{folder}/{os.getpid()}", "a") as out:
                out.write(what + "\n")

    def _lines(self, source):
        source.seek(0)
        return source.read().decode().split("\n")

    def count(self, source):
        lines = self._lines(source)
        self._note(source, f"open {len(lines)}")
        if lines[0] == "unreadable":
            raise KeyError("x")
        return 0 if lines == [""] else len(lines)

    def text(self, source, page):
        self._note(source, f"page {page + 1}")
        line = self._lines(source)[page]
        if line.startswith("bad"):
            raise OSError("page")
        return f" {line} " if line != "none" else None

    def has_image(self, source, page):
        return self._lines(source)[page].endswith("!")

    def image(self, source, page, dpi):
        return page, dpi, self._lines(source)[page].encode()
