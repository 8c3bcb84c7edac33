"""Validation patterns, name tables and code tables.

Each must equal the published value for results to agree, so they are stated
here as plain text.
"""

# Patterns, matched against the whole text. A dot stands for any character. The
# ones of host and user names are what `network` decides in linear time; only the
# SQL form of the query uses them as they stand.
ADDRESS = r"(25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)(.(25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)){3}"
HOST_NAME = (
    r"(([a-zA-Z0-9]|[a-zA-Z0-9][a-zA-Z0-9-]*[a-zA-Z0-9]).)*"
    r"([A-Za-z0-9]|[A-Za-z0-9][A-Za-z0-9-]*[A-Za-z0-9])"
)
USERNAME = r"[A-Za-z0-9]+(?:[._-][A-Za-z0-9]+)*"
TNS_NAME = r"[a-zA-Z][a-zA-Z0-9_.-]{0,29}"
CONSUMER_NAME = r"[A-Za-z0-9_.-]{1,128}"
ROW_ID = r"[A-Za-z0-9+/]{18}"
REGION = r"([a-zA-Z]{2,}(-|_))?[a-zA-Z]{2,4}(-|_)[a-zA-Z]{2,}(-|_)[0-9]{1,}"
STREAM_ARN = r"arn:aws:kinesis:[A-Za-z0-9-]+:[0-9]{12}:stream/([A-Za-z0-9_.-]{1,128})"
CONSUMER_ARN = STREAM_ARN + r"/consumer/[A-Za-z0-9_.-]{1,128}:[0-9]{10,}"

# Transfer protocols.
PROTOCOLS = {
    "UNKNOWN": -1,
    "NOTHING": 0,
    "FILE": 1,
    "SFTP": 2,
    "FTP": 3,
    "S3": 4,
    "SAMBA": 5,
    "HDFS": 6,
    "AWS": 7,
    "SCP": 8,
    "DATABASE": 9,
    "KAFKA": 10,
    "KINESIS": 11,
    "HTTP": 12,
}

# Authentication kinds.
AUTH_TYPES = {"UNKNOWN": -1, "PASSWORD": 0, "PRIVATEKEY": 1, "KERBEROS": 2, "NTLM": 3}

# Change flags of a table change feed.
CHANGE_FLAGS = {
    "allrows": 1,
    "insert": 2,
    "update": 4,
    "remove": 8,
    "alter": 16,
    "drop": 32,
    "unknown": 64,
}

# Log severities, most severe first.
LOG_LEVELS = [
    "EMERGENCY",
    "ALERT",
    "CRITICAL",
    "ERROR",
    "WARNING",
    "NOTICE",
    "INFO",
    "DEBUG",
]

# Characters the C locale counts as white space.
C_SPACE = r"[ \t\n\x0B\f\r]"

# Lines of a network element's response, each matched whole. No line holds a line
# end, so white space within one is any other white space.
RESPONSE_RETURN_CODE = r"RETCODE = ([0-9]{1,9})[ \t\x0B\f]+[^\n]*"
RESPONSE_END = r"---[ \t\x0B\f]+END"
RESPONSE_ERROR = r"ERROR"
RESPONSE_IMSI = r"[ \t\x0B\f]+IMSI[ \t\x0B\f]+=[ \t\x0B\f]+([0-9]+)"
RESPONSE_IMEI = r"[ \t\x0B\f]+IMEI[ \t\x0B\f]+=[ \t\x0B\f]+([0-9]+)"
RESPONSE_VLR = r"[ \t\x0B\f]+VLRNUM[ \t\x0B\f]+=[ \t\x0B\f]+([0-9]+)"
RESPONSE_CELL = (
    r"[ \t\x0B\f]+Cell[ \t\x0B\f]Identity[ \t\x0B\f]+=[ \t\x0B\f]+41220([a-zA-Z0-9]{4}[a-zA-Z0-9]{4})"
)
RESPONSE_ACTION = (
    r"[^\n]*action[ \t\x0B\f]+=[ \t\x0B\f]+"
    r"([0-9]{4}-[0-9]{2}-[0-9]{2}[ \t\x0B\f][0-9]{2}:[0-9]{2}:[0-9]{2})[^\n]*"
)

# Return codes that mean "already there" or "already gone".
ALREADY_CODES = (5952, 245952)
