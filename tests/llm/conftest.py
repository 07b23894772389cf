"""Texts that every operator has to bear: nulls, empty and long ones, ties, repeated rows."""

import pytest

SENTENCE = ("the quick brown fox jumps over the lazy dog while seven wizards brew a strange potion "
            "under an old bridge near the silent river").split()


def prose(seed: int, n: int) -> str:
    """n words that differ from those of any other seed."""
    return " ".join(f"{SENTENCE[(i * 7 + seed) % len(SENTENCE)]}{(seed * 31 + i * i) % 977}"
                    for i in range(n))


DOCS = "doc_id long, text string, lang string, N_Words string, score string, token_ids int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Edge cases, with extra columns whose names clash with those that operators add."""
    passage = prose(5, 80)
    rows = [
        (1, None, "en"), (2, "", "en"), (3, " \t\n ", None), (4, "Re.", "en"),
        (5, prose(1, 300), "en"), (6, prose(1, 300), "fr"), (7, prose(1, 300).upper(), "en"),
        (7, prose(1, 300).upper(), "en"), (8, prose(2, 3), "de"), (9, prose(2, 3), "de"),
        (10, prose(3, 60) + " " + passage + " " + prose(4, 60), "de"),
        (11, prose(6, 70) + "\n" + passage + "\t" + prose(7, 50), "es"),
        (12, passage, "es"), (13, "ñandú é 漢字 \U0001F600 " + prose(8, 40), "es"),
        (14, "123 456 !!!", "en"), (15, " ".join([prose(9, 1)] * 500), "en"),
        (16, prose(10, 20000), "en"), (17, "x" * 50000, "en"),
        (18, prose(1, 280) + " " + prose(11, 20), "en"), (None, prose(12, 120), "en"),
        (None, None, None), (-3, passage + " tail", "es"),
    ]
    return spark.createDataFrame([(*r, "w", "s", 1) for r in rows], DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
