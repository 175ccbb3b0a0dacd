"""Fixed schemas of the inputs."""

from pyspark.sql import types as T


def simple_struct(fields: str) -> T.StructType:
    """A struct of simple types from ``name type, name type``, without a session."""
    struct = T.StructType()
    for field in fields.split(","):
        name, kind = field.split()
        struct = struct.add(name, kind)
    return struct


# Field names, order and types of a change event.
CHANGE_SCHEMA = simple_struct(
    "$schema string, meta string, id long, type string, namespace integer, title string, "
    "title_url string, comment string, timestamp long, user string, bot boolean, "
    "notify_url string, minor boolean, length string, revision string, server_url string, "
    "server_name string, server_script_path string, wiki string, parsedcomment string"
)

CORRUPT = "_corrupt_record"
CHECKED_CHANGE_SCHEMA = T.StructType(CHANGE_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType())])

# The only fields that decide whether a raw message is kept.
ROUTING_SCHEMA = (
    T.StructType()
    .add("meta", simple_struct("domain string"))
    .add("server_name", "string")
    .add("type", "string")
    .add(CORRUPT, "string")
)

# Topic records as the connector delivers them.
RECORD_SCHEMA = simple_struct("key binary, value binary, timestamp timestamp")

LISTING_SCHEMA = simple_struct("id long, name string")

# Nesting of the top-articles response.
ARTICLES_SCHEMA = T.StructType().add("items", T.ArrayType(
    T.StructType().add("articles", T.ArrayType(simple_struct("article string, views long, rank long")))
))

METRIC_COLUMNS = [
    "window_start", "window_end", "accuracy", "precision", "recall", "f1_score",
    "total_observations", "true_positives", "false_positives", "false_negatives",
]
