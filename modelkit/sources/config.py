"""Connector settings from the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class StreamConfig:
    """Kafka and JDBC settings. Secrets are kept out of ``repr``."""

    brokers: str
    topic: str
    group: str
    key: str = field(default="", repr=False)
    secret: str = field(default="", repr=False)
    jdbc_url: str = ""
    jdbc_user: str = ""
    jdbc_password: str = field(default="", repr=False)
    trigger: str = "10 seconds"
    watermark: str = "15 seconds"

    # Names of the environment variables.
    REQUIRED = {"brokers": "STREAM_BROKERS", "topic": "STREAM_TOPIC", "group": "STREAM_GROUP"}
    OPTIONAL = {
        "key": "STREAM_KEY",
        "secret": "STREAM_SECRET",
        "jdbc_url": "SINK_JDBC_URL",
        "jdbc_user": "SINK_JDBC_USER",
        "jdbc_password": "SINK_JDBC_PASSWORD",
    }

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> StreamConfig:
        source = os.environ if env is None else env
        missing = [v for v in cls.REQUIRED.values() if not source.get(v)]
        if missing:
            raise KeyError(f"missing environment variables: {', '.join(missing)}")
        values = {name: source[var] for name, var in cls.REQUIRED.items()}
        values |= {name: source[var] for name, var in cls.OPTIONAL.items() if var in source}
        return cls(**values)

    def kafka_options(self) -> dict[str, str]:
        options = {"kafka.bootstrap.servers": self.brokers}
        if self.key:
            login = "org.apache.kafka.common.security.plain.PlainLoginModule"
            options |= {
                "kafka.security.protocol": "SASL_SSL",
                "kafka.sasl.mechanism": "PLAIN",
                "kafka.sasl.jaas.config": f'{login} required username="{self.key}" password="{self.secret}";',
            }
        return options

    def jdbc_options(self) -> dict[str, str]:
        return {
            "user": self.jdbc_user,
            "password": self.jdbc_password,
            "driver": "org.postgresql.Driver",
        }
