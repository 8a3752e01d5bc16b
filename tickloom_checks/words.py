"""Word pieces that occur in the test conversations, in place of the default
ticker and keyword lists, which hardly do."""

# Chosen so that every branch of the intent rules is taken.
TICKER_PIECES = ("los", "ber", "que")
PREDICTION_PIECES = ("what", "und")
DATA_PIECES = ("est", "data")
# The tickers of the test bars.
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
# Ten thousand tickers by a rule, most of which occur nowhere.
MANY_PIECES = tuple(f"{a}{b}{c}{d}".upper() for a in "qxzvjkwygf" for b in "eaioubtnrs" for c in "abcdeghimo" for d in "lmnrstuwyz")
