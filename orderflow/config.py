"""The one YAML file both jobs take."""

from __future__ import annotations

# Section and key names of the configuration file.
REQUIRED_KEYS = {
    "postgres": ["jdbc_url", "user", "password", "table"],
    "kafka": ["brokers", "topic"],
    "datalake": ["path", "format"],
    "streaming": ["checkpoint_location", "last_processed_timestamp_location", "batch_interval"],
}


def load_config(config_path: str) -> dict:
    import yaml

    with open(config_path, encoding="utf-8") as handle:
        config = yaml.safe_load(handle) or {}
    missing = [
        f"{section}.{key}"
        for section, keys in REQUIRED_KEYS.items()
        for key in keys
        if key not in (config.get(section) or {})
    ]
    if missing:
        raise ValueError(f"{config_path}: missing {', '.join(missing)}")
    return config
