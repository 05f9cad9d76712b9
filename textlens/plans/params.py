"""Parameters shared by the registered queries and their SQL oracles.

Doubles in query outputs are rounded to ``DIGITS`` places on both sides.
"""

DIGITS = 6

# three-class explanation set (documents.lang); selection order matters
CHOSEN = ("en", "fr", "de")
PREFERRED = "en"
TOP_N = 150  # top-words list length of the word-frequency view
CHUNK = 25  # default reset step of the running score
AXIS_CAP = 33  # start of the axis minimum

PICK_PCT = 25  # default pick percentage of the folder reader
RATIO = 75  # default train share

FLOOR_V = 5  # slider exponent for the floored score: zero_fix = 1 / 10**5
UNCLASSIFIED_REJECT = -3000.0  # a reject limit that leaves long documents unclassified

LINE_TRAIN_PCT = 75  # labelled lines: first 75 % train
