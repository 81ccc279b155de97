"""Pattern recognisers: what an entity looks like, and how sure a hit is.

A recogniser is plain data (a Java regex, a score, an optional validator);
``spans.detect`` turns a list of them into one native Spark expression.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from typing import Optional

# --- fixed values --------------------------------------------------------
# Entity names, patterns and scores of the built-in recognisers.  The
# patterns avoid lookaround so the same text runs in Java (Spark) and RE2
# (DuckDB oracle).  Scores are our own fixed confidence per recogniser.
#
#   EMAIL_ADDRESS  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}   1.0
#   IP_ADDRESS     \b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b                                   0.6
#   CREDIT_CARD    \b[0-9]{13,16}\b   (+ Luhn check)                                   1.0
#   PHONE_NUMBER   \+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}                                  0.75
#   SECRET_TOKEN   [0-9a-f]{40,}                                                       0.85
#   URL            https?://[A-Za-z0-9./?=&_%#:-]+                                     0.5
#
# Spark matches with Java's backtracking engine, so the e-mail pattern has a second
# spelling for it that finds the same spans in linear time and without recursion: a
# match starts where a run of local-part characters does (or where the last match
# ended), every loop is possessive, and a label is passed whole only if a later one begins
# with two letters.
#
# Replacement token for columns known to be personal on every row:
#   <PII_MASKED>
# Value put in the result struct for each such column:
#   Full mask
# -------------------------------------------------------------------------

EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
EMAIL_JAVA = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++"
    r"(?:(?:\.(?![A-Za-z]{2})[A-Za-z0-9-]++)*+\.[A-Za-z]{2,}+"
    r"(?:[A-Za-z0-9-]*+(?=(?:\.(?![A-Za-z]{2})[A-Za-z0-9-]++)*+\.[A-Za-z]{2}))?+)++"
)
IP_PATTERN = r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b"
CARD_PATTERN = r"\b[0-9]{13,16}\b"
PHONE_PATTERN = r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}"
SECRET_PATTERN = r"[0-9a-f]{40,}"
URL_PATTERN = r"https?://[A-Za-z0-9./?=&_%#:-]+"

PII_MASKED = "<PII_MASKED>"
FULL_MASK = "Full mask"


@dataclass(frozen=True)
class Recognizer:
    """One entity detector expressed as a regular expression.

    ``pattern`` reads alike in Java, RE2 and Python; ``java`` is a spelling for Spark
    that finds the same spans where the plain one would backtrack too much.

    ``hint`` is a literal that every match must contain; texts without it
    skip the regex entirely (a cheap ``instr`` before a full regex pass).
    ``languages`` limits the recogniser to texts of these languages (empty: all); it
    matters only where the caller says which language a text has.
    ``validator`` names a SQL boolean function applied to the matched text
    (``luhn_check`` for cards); spans failing it are dropped.
    ``alphabet`` is the inside of a character class with every character that a match can hold: a long
    text may be cut after any other character (beside a word boundary, patterns must not look further than that).
    """

    entity_type: str
    pattern: str
    score: float
    hint: Optional[str] = None
    validator: Optional[str] = None
    java: Optional[str] = None
    languages: tuple[str, ...] = ()
    alphabet: Optional[str] = None

    def __post_init__(self):
        compiled = re.compile(self.pattern)
        if compiled.match("") is not None:
            # A zero-width match would desynchronise the split/extract pairing
            # used to compute offsets.
            raise ValueError(f"pattern for {self.entity_type} can match the empty string")

    def for_languages(self, *languages: str) -> "Recognizer":
        return replace(self, languages=tuple(languages))

    def without_validator(self) -> "Recognizer":
        return replace(self, validator=None)


EMAIL = Recognizer("EMAIL_ADDRESS", EMAIL_PATTERN, 1.0, hint="@", java=EMAIL_JAVA, alphabet="A-Za-z0-9._%+@-")
IP_ADDRESS = Recognizer("IP_ADDRESS", IP_PATTERN, 0.6, hint=".", alphabet="0-9.")
CREDIT_CARD = Recognizer("CREDIT_CARD", CARD_PATTERN, 1.0, validator="luhn_check", alphabet="0-9")
PHONE = Recognizer("PHONE_NUMBER", PHONE_PATTERN, 0.75, hint="+1 (", alphabet="0-9+() -")
SECRET = Recognizer("SECRET_TOKEN", SECRET_PATTERN, 0.85, alphabet="0-9a-f")
URL = Recognizer("URL", URL_PATTERN, 0.5, hint="://", alphabet="A-Za-z0-9./?=&_%#:-")

BUILTIN = {r.entity_type: r for r in (EMAIL, IP_ADDRESS, CREDIT_CARD, PHONE, SECRET, URL)}

# Entities scanned when the caller names none: everything except URL, which
# is usually wanted in clear text.
DEFAULT_ENTITIES = ("EMAIL_ADDRESS", "IP_ADDRESS", "CREDIT_CARD", "PHONE_NUMBER", "SECRET_TOKEN")


def get_recognizers(entities=None, extra=()) -> list[Recognizer]:
    """Resolve entity names (or ``"ALL"``) to recognisers, plus user ones."""
    if entities is None:
        names = list(DEFAULT_ENTITIES)
    elif entities == "ALL" or (not isinstance(entities, str) and "ALL" in entities):
        names = list(BUILTIN)
    elif isinstance(entities, str):
        names = [entities]
    else:
        names = list(entities)
    out = []
    for n in names:
        if isinstance(n, Recognizer):
            out.append(n)
        elif n in BUILTIN:
            out.append(BUILTIN[n])
        else:
            raise KeyError(f"unknown entity {n!r}; known: {sorted(BUILTIN)}")
    out.extend(extra)
    return out
