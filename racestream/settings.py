"""Names and defaults shared by every job, and the settings a deployment may override."""

from __future__ import annotations

import os
from dataclasses import dataclass

# Topic names, publish key of race-control messages, job defaults.
TOPIC_POSITIONS = "f1.positions"
TOPIC_LAPS = "f1.laps"
TOPIC_PIT_STOPS = "f1.pit_stops"
TOPIC_RACE_CONTROL = "f1.race_control"
TOPIC_LEADERBOARD = "f1.leaderboard"
TOPIC_LAPS_ENRICHED = "f1.laps_enriched"
TOPIC_ALERTS = "f1.alerts"
RACE_CONTROL_KEY = "rc"
DEFAULT_BOOTSTRAP_SERVERS = "localhost:9092"
DEFAULT_SESSION_KEY = 9161
DEFAULT_REPLAY_SPEED = 2.0
LEADERBOARD_WINDOW = "10 seconds"
OUT_OF_ORDERNESS = "5 seconds"
PRODUCER_ACKS = "1"
PRODUCER_RETRIES = "3"
PRODUCER_LINGER_MS = "5"


@dataclass(frozen=True)
class Settings:
    bootstrap_servers: str = DEFAULT_BOOTSTRAP_SERVERS
    session_key: int = DEFAULT_SESSION_KEY
    replay_speed: float = DEFAULT_REPLAY_SPEED

    def __post_init__(self):
        if not self.replay_speed > 0:
            raise ValueError(f"replay speed must be positive, got {self.replay_speed}")

    @classmethod
    def from_env(cls, env=None) -> "Settings":
        env = os.environ if env is None else env
        return cls(
            bootstrap_servers=env.get("KAFKA_BOOTSTRAP_SERVERS", DEFAULT_BOOTSTRAP_SERVERS),
            session_key=int(env.get("SESSION_KEY", DEFAULT_SESSION_KEY)),
            replay_speed=float(env.get("REPLAY_SPEED", DEFAULT_REPLAY_SPEED)),
        )
