"""The small corpus of the tests, with its anchors and queries."""

MINI_STOP = ("the", "and")
MINI_DOCS = [
    (1, "Rubber duck rubber boat", "Rubber duck"),
    (2, "Duck pond and duck food", "Duck"),
    (3, "Boat race: rubber rubber rubber dinghy", "Dinghy race"),
    (4, "Pond life", "Pond life"),
    (5, "The duck!", None),
]
MINI_ANCHORS = [(1, "rubber duck"), (1, "duck"), (2, "duck pond"), (3, "boat")]
MINI_QUERIES = [(1, "rubber duck"), (2, "duck boat zebra"), (3, "duck duck"), (4, "")]
