import hashlib

import pytest

from actionlens.functions.digests import uniforms


@pytest.mark.parametrize("length", [0, 3, 18, 46, 47, 54, 55, 56, 63, 64, 65, 118, 130])
@pytest.mark.parametrize("start, stop", [(0, 1), (0, 120), (9_990, 10_010), (123_456_789, 123_456_800), (2**32 - 5, 2**32 + 5)])
def test_uniforms_are_those_of_each_text(length, start, stop):
    """Texts that end before, at and behind the end of a block, and numbers of several lengths."""
    prefix = ("7|größer|12|" * 12)[:length]
    for prefixes in ([prefix], [prefix + x for x in ("0|", "5|", "9|")], [x + prefix for x in "ab"]):
        texts = [[hashlib.md5(f"{p}{i}".encode()).hexdigest()[:13] for i in range(start, stop)] for p in prefixes]
        assert uniforms(prefixes, start, stop).tolist() == [[(int(d, 16) + 0.5) / 2**52 for d in of_prefix] for of_prefix in texts]
