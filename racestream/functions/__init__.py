from racestream.functions.event_time import event_time
from racestream.functions.json_codec import decode, encode, split_malformed
from racestream.functions.severity import classify

__all__ = ["classify", "decode", "encode", "event_time", "split_malformed"]
