"""Arguments of the registered queries on the stand-in tables.

Dates are no parameters: each query covers every day that the tables hold
(``Tables.scope``), the promo report's history included. Titles and patterns are
the stand-in's counterparts of the daily scripts' literals.
"""

TARGET = "alpha show"
DESTINATIONS = ("bravo: live!", "view-all")
DEVICE_LIKE = "%fire%tv%"
PROMO_ORIGINS = ("%bravo%", "%charlie%")
PROMO_VIEW_TITLES = ("alpha show", "bravo: live!")
#: Ranks of the top feeders reports, as published.
TOP_K = 50
CUE_PREFIX = "s|a|b"
