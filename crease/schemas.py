"""Explicit schemas: the raw match document, raw tables, seeds.

JSON is never schema-inferred. ``extras`` is a map so that the presence of a key
(``"wides": 1`` or even ``"wides": null``) stays observable after parsing: a ball is
legal only when neither ``wides`` nor ``noballs`` is present.
"""

from pyspark.sql import types as T

S, I, B = T.StringType(), T.IntegerType(), T.BooleanType()

RUNS = T.StructType([
    T.StructField("batter", I),
    T.StructField("extras", I),
    T.StructField("total", I),
])

WICKET = T.StructType([
    T.StructField("player_out", S),
    T.StructField("kind", S),
])

DELIVERY = T.StructType([
    T.StructField("batter", S),
    T.StructField("non_striker", S),
    T.StructField("bowler", S),
    T.StructField("runs", RUNS),
    T.StructField("extras", T.MapType(S, I)),
    T.StructField("wickets", T.ArrayType(WICKET)),
])

OVER = T.StructType([
    T.StructField("over", I),
    T.StructField("deliveries", T.ArrayType(DELIVERY)),
])

INNINGS = T.StructType([
    T.StructField("team", S),
    T.StructField("super_over", B),
    T.StructField("overs", T.ArrayType(OVER)),
])

MARGIN = T.StructType([
    T.StructField("runs", I),
    T.StructField("wickets", I),
    T.StructField("innings", I),
])

INFO = T.StructType([
    T.StructField("match_type", S),
    T.StructField("gender", S),
    T.StructField("dates", T.ArrayType(S)),
    T.StructField("venue", S),
    T.StructField("city", S),
    T.StructField("event", T.StructType([
        T.StructField("name", S),
        T.StructField("match_number", I),
        T.StructField("stage", S),
    ])),
    T.StructField("toss", T.StructType([
        T.StructField("winner", S),
        T.StructField("decision", S),
    ])),
    T.StructField("outcome", T.StructType([
        T.StructField("winner", S),
        T.StructField("result", S),
        T.StructField("by", MARGIN),
    ])),
    T.StructField("player_of_match", T.ArrayType(S)),
    T.StructField("teams", T.ArrayType(S)),
    T.StructField("players", T.MapType(S, T.ArrayType(S))),
    T.StructField("registry", T.StructType([
        T.StructField("people", T.MapType(S, S)),
    ])),
])

MATCH_DOC = T.StructType([
    T.StructField("info", INFO),
    T.StructField("innings", T.ArrayType(INNINGS)),
])

# Balls stay whole: keys that no column names (fielders, reviews, ..) are kept.
RAW_INNINGS = T.StructType([
    T.StructField("team", S),
    T.StructField("super_over", B),
    T.StructField("overs", T.ArrayType(T.StructType([
        T.StructField("over", I),
        T.StructField("deliveries", T.ArrayType(T.VariantType())),
    ]))),
])

RAW_DOC = T.StructType([
    T.StructField("info", INFO),
    T.StructField("innings", T.ArrayType(RAW_INNINGS)),
])

# raw layer -------------------------------------------------------------------------

REGISTRY = T.StructType([
    T.StructField("filename", S),
    T.StructField("file_hash", S),
    T.StructField("ingested_at", T.TimestampType()),
])

MATCHES_RAW = T.StructType([
    T.StructField("match_id", I),
    T.StructField("hash_id", S),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("info", INFO),
    T.StructField("document", T.VariantType()),
])

DELIVERIES_RAW = T.StructType([
    T.StructField("match_id", I),
    T.StructField("hash_id", S),
    T.StructField("n_innings", I),
    T.StructField("team", S),
    T.StructField("n_over", I),
    T.StructField("n_delivery", I),
    T.StructField("super_over", B),
    T.StructField("delivery", DELIVERY),
])

#: The same with the whole ball.
DELIVERIES_WHOLE = T.StructType([*DELIVERIES_RAW.fields[:-1], T.StructField("delivery", T.VariantType())])

QUARANTINE = T.StructType([
    T.StructField("filename", S),
    T.StructField("file_hash", S),
    T.StructField("reason", S),
])

SRC_VENUES = T.StructType([
    T.StructField("venue_name", S),
    T.StructField("city", S),
])

VENUE_CITY = T.StructType([
    T.StructField("venue_name", S),
    T.StructField("city", S),
])

CITY_COUNTRY = T.StructType([
    T.StructField("city", S),
    T.StructField("country", S),
])
