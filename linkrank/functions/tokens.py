"""Titles as tokens of a text file, and back.

Tokens are separated by white space, so white space inside a title, and an empty title, are
written as an escape character and a letter. The escape is a control character that XML text
cannot hold: titles of a dump are written as they are, and one that holds it all the same is
escaped itself.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the text form.
ESCAPE = "\x1b"
EMPTY = ESCAPE + "0"
LETTERS = {ESCAPE: "e", " ": "s", "\t": "t", "\n": "n", "\v": "v", "\f": "f", "\r": "r"}


def to_token(title: Column) -> Column:
    """One token, whatever the title holds."""
    token = title
    for character, letter in LETTERS.items():
        token = F.replace(token, F.lit(character), F.lit(ESCAPE + letter))
    odd = F.rlike(title, F.lit(r"[\s\x1B]"))
    return F.when(odd, token).when(title == "", EMPTY).otherwise(title)


def from_token(token: Column) -> Column:
    """The title of a token."""
    title = token
    # The escape's own code last: what it gives back begins no other code.
    for character, letter in reversed(LETTERS.items()):
        title = F.replace(title, F.lit(ESCAPE + letter), F.lit(character))
    odd = F.contains(token, F.lit(ESCAPE))
    return F.when(token == EMPTY, "").when(odd, title).otherwise(token)
