"""Times that the registered queries and their SQL share, in ms."""

# Batches of the replayed stream: slices of sixteen days of receive time.
SLICE_MS = 1_382_400_000
REPLAY_HOLD_MS = 7_200_000
# Traces count as late after four days in the replay that tests lateness.
LATE_MS = 345_600_000
# The fixed time of the hold and day-scan queries: 2024-01-31 18:00 UTC.
AS_OF = 1_706_724_000_000
# 2024-01-01, where the events begin.
FIRST_MS = 1_704_067_200_000
# Ten slices of the messages that wait for a stream, by receive time; files of each.
BACKLOG_MS = 267_840_000
BACKLOG_FILES = 4
# Texts come a language an hour; words are forgotten after an hour and a half.
TEXT_SECONDS = 3_600
FORGET = "90 minutes"
# Ten days from 2024-01-06, in seconds, noon to noon.
LOOKUP_FIRST = 1_704_542_400
LOOKUP_LAST = 1_705_406_400
