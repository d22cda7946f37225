"""Table schemas and fixed vocabulary values shared by all operators."""

from pyspark.sql import types as T

# ---- fixed values (must equal the reference's tokenizer for identical ids) ----
# Special tokens in id order 0..6.
SPECIAL_TOKENS = ["<pad>", "<unk>", "<bos>", "<eos>", "<user>", "<assistant>", "<sep>"]
PAD_ID, UNK_ID, BOS_ID, EOS_ID, USER_ID, ASSISTANT_ID, SEP_ID = range(7)
# Role markers written into the vocabulary corpus (system has no token of its own).
ROLE_MARKERS = {"user": "<user>", "assistant": "<assistant>", "system": "<system>"}
# Defaults of the training configuration.
DEFAULT_SEQ_LEN = 256
DEFAULT_BATCH_SIZE = 8
DEFAULT_EPOCHS = 12
DEFAULT_TEMPERATURE = 0.75
DEFAULT_TOP_K = 40
DEFAULT_TOP_P = 0.9
DEFAULT_REPETITION_PENALTY = 1.15
# Characters removed by Python's str.strip() (str.isspace() is true for exactly these).
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# -------------------------------------------------------------------------------

TURN = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
DIALOG = T.ArrayType(TURN)

SAMPLES = T.StructType([
    T.StructField("sample_id", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("dialog", DIALOG),
    T.StructField("source", T.StringType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("ordinal", T.LongType()),
    T.StructField("type", T.StringType()),
    T.StructField("turns", T.IntegerType()),
    T.StructField("category", T.StringType()),
    T.StructField("metadata", T.StringType()),
    T.StructField("format", T.StringType()),
])
SAMPLE_COLUMNS = [f.name for f in SAMPLES.fields]

QUARANTINE = T.StructType([
    T.StructField("file_path", T.StringType()),
    T.StructField("ordinal", T.LongType()),
    T.StructField("raw", T.StringType()),
    T.StructField("reason", T.StringType()),
])

VOCAB = T.StructType([
    T.StructField("token", T.StringType()),
    T.StructField("id", T.IntegerType()),
    T.StructField("is_special", T.BooleanType()),
])

WINDOWS = T.StructType([
    T.StructField("sample_id", T.StringType()),
    T.StructField("window_no", T.IntegerType()),
    T.StructField("input_ids", T.ArrayType(T.IntegerType())),
    T.StructField("target_ids", T.ArrayType(T.IntegerType())),
    T.StructField("loss_mask", T.ArrayType(T.ByteType())),
])

TOKENS = T.StructType([
    T.StructField("sample_id", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("token_ids", T.ArrayType(T.IntegerType())),
])

TRAIN_LOG = T.StructType([
    T.StructField("run_id", T.LongType()),
    T.StructField("epoch", T.IntegerType()),
    T.StructField("step", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("loss", T.DoubleType()),
    T.StructField("grad_norm", T.DoubleType()),
    T.StructField("mask_mean", T.DoubleType()),
])
