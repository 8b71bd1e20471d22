"""Random strings of 12 characters and more, and of letters only, against clean strings."""

import random
import string

import public_tokenizers
import pytest

from arcweave.llm import secrets


@pytest.fixture(scope="module")
def encoder():
    return secrets.encoder_of(public_tokenizers.path(secrets.VOCABULARY))


@pytest.mark.parametrize("letters, length, least", [("base62", 12, 0.85), ("base62", 16, 0.9), ("base62", 19, 0.9), ("mixed", 20, 0.9), ("mixed", 40, 0.9)])
def test_random_strings_are_found(encoder, letters, length, least):
    rng = random.Random(length)
    alphabet = string.ascii_letters + string.digits * (letters == "base62")
    given = ["".join(rng.choices(alphabet, k=length)) for _ in range(500)]
    found = [secrets.random_spans(f"see {s} there", encoder) == [(4, 4 + length, 3)] for s in given]
    assert sum(found) >= least * len(found)


def test_clean_strings_are_not(encoder):
    clean = """internationalization InternationalBusiness getElementsByClassName HttpServletRequest iPhone12ProMax covid19-related
    2023-11-05T12:30:00Z 20231105T123456Z x86_64-linux-gnu utf-8-encoded B2B-SaaS-CRM-v2 iOS/macOS/tvOS/iPadOS Donaudampfschifffahrt
    OpenStreetMapFoundation /usr/local/share/Doc --no-Verify-names 123456789012 d41d8cd98f00b204e9800998ecf8427e DELASADOBOGA someone12345@example.org"""
    assert secrets.random_spans(clean, encoder) == []
