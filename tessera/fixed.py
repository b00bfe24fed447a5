"""Fixed values.

These must equal the values the reference uses, so that reports, keys and
types read the same. They are stated once here, in plain text.
"""

# Name of the document id field, and the default primary key.
ID_FIELD = "_id"

# Relation kinds of child tables: embedded struct, embedded array.
RELATION_ONE_TO_ONE = "1_1"
RELATION_ONE_TO_MANY = "1_n"

# Type names that composite JSON values collapse to.
STRUCT_TYPE_NAME = "struct"
ARRAY_TYPE_NAME = "array"

# Documents sampled per collection for value matching.
SAMPLE_DOCUMENTS = 10

# Rows per INSERT batch when writing tables.
INSERT_BATCH_ROWS = 1000

# Column type for keys and link sources in created tables.
KEY_COLUMN_TYPE = "VARCHAR(255)"

# Status and message of a successful metadata report.
REPORT_STATUS = "200"
REPORT_MESSAGE = "Success"
