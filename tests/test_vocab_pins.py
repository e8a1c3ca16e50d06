"""The fixed lists are pinned: the oracle reads the same lists, so a changed word would
otherwise stay unseen. (length, first 16 hex digits of the SHA-256 of the lines)."""

import hashlib

import pytest

from vacanta.functions import vocab as V

PINS = {
    "ALLOWED_DOMAINS": (13, "0911ee551e0ed795"),
    "ALTERNANCE_CONTRACT_WORDS": (3, "9902787f4f7d6c2f"),
    "APPLICATION_WORDS": (5, "ead04a6787bb208f"),
    "CATEGORY_ALTERNANCE_WORDS": (5, "d38f8ffffe403cc3"),
    "CDD_WORDS": (2, "248692a8b33f0c07"),
    "CDI_WORDS": (2, "30fb57cc10bd2f31"),
    "COMPANY_STOPS": (3, "487fa1e8706e6dd9"),
    "COMPANY_VERBS": (2, "51b132b0dc93e11e"),
    "DURATION_BRACKETS": (5, "571865f0f843a051"),
    "FREELANCE_WORDS": (2, "6b4cebfd49d3d052"),
    "FULL_REMOTE_WORDS": (4, "f54d51a588c3f576"),
    "HYBRID_WORDS": (3, "5399ff607f349b29"),
    "INGEST_ALTERNANCE_WORDS_API": (3, "02705a7b750d8723"),
    "INGEST_ALTERNANCE_WORDS_PAGES": (2, "be413aaac196f8c1"),
    "INGEST_HYBRID_WORDS_API": (4, "4ba4ddf659d05cd6"),
    "INGEST_MONTH_UNITS": (2, "a437a61e4d9652f5"),
    "INGEST_PAID_WORDS_API": (7, "3c91ad3e1a439d89"),
    "INGEST_PAID_WORDS_PAGES": (6, "db9fba92fbfd4c44"),
    "INGEST_PFE_WORDS_API": (3, "173d5b13e888e178"),
    "INGEST_PFE_WORDS_PAGES": (4, "ac3aa467e1282060"),
    "INGEST_STAGE_WORDS_API": (4, "c323423322f85f9b"),
    "INGEST_STAGE_WORDS_PAGES": (3, "0f72efcba355d8da"),
    "INITIATION_WORDS": (4, "5fd62449702f7dc2"),
    "INTERNSHIP_CONTRACT_WORDS": (2, "1a792304fd07d5f6"),
    "INTERNSHIP_WORDS": (8, "d6e8fb308abc17db"),
    "MONTH_UNITS": (4, "11163555df3d554c"),
    "PAID_WORDS": (7, "6944c1b94fabeaa1"),
    "PFE_WORDS": (9, "712ca97dacbe0507"),
    "RANGE_SEPARATORS": (3, "0e4520f358aa4ccb"),
    "REMOTE_WORDS": (2, "2030a94f81811125"),
    "SOURCES": (4, "9a817760466968d6"),
    "TAXONOMY": (12, "f88c0ea58753bcc6"),
    "TEXT_CITIES": (13, "4c080eb2b8b1dc69"),
    "UNPAID_WORDS": (4, "8436acadb754406f"),
    "WEEK_UNITS": (5, "045a6086cf80d995"),
}


def digest(x) -> str:
    if isinstance(x, dict) and all(isinstance(v, (list, tuple)) for v in x.values()):
        lines = [f"{k}: {', '.join(v)}" for k, v in x.items()]
    else:
        lines = map(str, x.items() if isinstance(x, dict) else x)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


@pytest.mark.parametrize("name", PINS)
def test_list(name):
    assert (len(getattr(V, name)), digest(getattr(V, name))) == PINS[name]


def test_some_words_literally():
    assert V.SOURCES[0] == "adzuna_api" and len(V.SOURCES) == 4
    assert "stage" in V.INTERNSHIP_WORDS and "pfe" in V.PFE_WORDS and "cdi" in V.CDI_WORDS
    assert {"Casablanca", "Rabat", "Tanger"} <= set(V.TEXT_CITIES)
