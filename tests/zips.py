"""Build small archives for tests."""

import io
import zipfile


def make_zip(members, method=zipfile.ZIP_DEFLATED, directories=()):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as archive:
        for name in directories:
            archive.writestr(zipfile.ZipInfo(name), b"")
        for name, data in members:
            archive.writestr(name, data)
    return out.getvalue()


def without_utf8_flag(name: str, data: bytes) -> bytes:
    """An archive whose only entry has a Korean name in cp949 and no UTF-8 flag."""
    raw = name.encode("cp949")
    plain = make_zip([("x" * len(raw), data)], zipfile.ZIP_STORED)
    return plain.replace(b"x" * len(raw), raw)
