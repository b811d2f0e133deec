"""Classes of keys, and how far the allow-list reaches."""

import base64
import hashlib
import random
import string

import pytest

from urlsift.llm import secrets

KEYS = {
    "base36": string.ascii_lowercase + string.digits,
    "base32": string.ascii_uppercase + "234567",
    "base64url": string.ascii_letters + string.digits + "-_",
    "base64": string.ascii_letters + string.digits + "+/",
    "hex": "0123456789ABCDEF",
}


def covered(text, key):
    a = text.index(key)
    return any(x <= a and a + len(key) <= y for x, y, _ in secrets.entropy_spans(text))


@pytest.mark.parametrize("kind", KEYS)
def test_keys_of_every_class_are_found(kind):
    rng = random.Random(kind)
    keys = ["".join(rng.choice(KEYS[kind]) for _ in range(48)) for _ in range(200)]
    found = [secrets.entropy_spans(f"see {k} here") for k in keys]
    assert all(len(x) <= 2 for x in found) and sum(bool(x) for x in found) >= 195


def test_a_url_safe_token_is_not_cut_at_its_marks():
    token = "aB3dE6-hJ9kL2_nP5qR8-tV1wX4_zC7fG0"
    assert secrets.entropy_spans(f"id {token} end") == [(3, 3 + len(token), "entropy")]


@pytest.mark.parametrize("mark", secrets.ALLOWED_MARKS)
def test_marks_reach_their_own_piece_only(mark):
    key = "wJa1rXUtn9FEMI2K7MDENGbPxRfiCYzQ"
    for text in (f"/{mark}s/cfg/{key}", f"{key}/{mark}", f"{mark}={key}", f"{key}/q/{mark}/{key}"):
        assert covered(text, key)
    assert secrets.entropy_spans(f"/a/{mark}{key}/b") == []


def test_digests_are_allowed_whole_and_nothing_behind_them():
    key = "wJa1rXUtn9FEMI2K7MDENGbPxRfiCYzQ"
    for name in ("md5", "sha1", "sha256", "sha384", "sha512"):
        for k in range(40):
            data = hashlib.new(name, str(k).encode())
            for digest in (data.hexdigest().upper(), base64.b64encode(data.digest()).decode()):
                assert secrets.entropy_spans(f"{name}-{digest}") == []
                assert covered(f"{name}-{digest}/{key}", key)
    assert covered(f"sha256-{key}/{key}{key}", f"{key}{key}")


def test_words_and_ids_are_no_keys():
    for text in ("internationalisation2024", "SOME_LONG_CONSTANT_NAME_2", "/usr/share/doc/packages/readme", "123e4567-e89b-12d3-a456-426614174000/x" * 3):
        assert secrets.entropy_spans(text) == [], text
