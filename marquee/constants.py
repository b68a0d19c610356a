"""Values that must equal the reference's for the same results, stated in one place."""

# Fixed values (as in the reference): dump format, list encodings, acting
# categories, the windows of the three vote streams, and the top-list sizes.
FIELD_SEPARATOR = "\t"
NULL_MARKER = "\\N"
HEADER_TITLE_KEY = "tconst"
HEADER_PERSON_KEY = "nconst"
LIST_SEPARATOR = ","
PAIR_SEPARATOR = "#"
LOG_LINE_BRACKETS = "[()]"
PERFORMER_WORDS = ("actor", "actress")
LOG_WINDOW = "10 minutes"
TOP_WINDOW = "10 minutes"
TOP_SLIDE = "1 minute"
TREND_WINDOW = "15 minutes"
TOP_PEOPLE_N = 10
TOP_TITLES_N = 3
TOP_WINDOW_N = 3
RATING_DECIMALS = 1

# Our own choices (not in the reference): the log label carries the date.
LOG_LABEL_FORMAT = "yyyy-MM-dd_HH_mm"
