import pytest

from kerbflow.config import FlowConfig, WindowSpec, duration_micros


@pytest.mark.parametrize(
    "text, micros",
    [
        ("5 minutes", 300_000_000),
        ("1 minute", 60_000_000),
        ("90 seconds", 90_000_000),
        ("1 hour 30 minutes", 5_400_000_000),
        ("INTERVAL 10 Minutes", 600_000_000),
        ("250 milliseconds", 250_000),
        ("1 week", 604_800_000_000),
    ],
)
def test_duration(text, micros):
    assert duration_micros(text) == micros


@pytest.mark.parametrize("text", ["", "soon", "5", "minutes", "1 month", "2 years", "5 minutes or so"])
def test_bad_duration(text):
    with pytest.raises(ValueError):
        duration_micros(text)


def test_window_shapes():
    assert WindowSpec().panes_per_window == 5
    assert WindowSpec("10 minutes", "4 minutes").pane_micros == 120_000_000
    assert WindowSpec("5 minutes", None).panes_per_window == 1
    for size, slide in (("1 minute", "5 minutes"), ("0 minutes", "0 minutes")):
        with pytest.raises(ValueError):
            WindowSpec(size, slide)


def test_defaults_and_environment():
    plain = FlowConfig.from_env({})
    assert (plain.kafka_servers, plain.kafka_topic) == ("kafka:29092", "taxi-events")
    assert (plain.watermark_delay, plain.trigger_interval, plain.chunk_size) == ("10 minutes", "30 seconds", 10_000)
    assert plain.window == WindowSpec("5 minutes", "1 minute")
    assert plain.jdbc_password is None
    env = {
        "KAFKA_BOOTSTRAP_SERVERS": "b:1",
        "KAFKA_TOPIC": "t",
        "POSTGRES_URL": "jdbc:x",
        "POSTGRES_USER": "u",
        "POSTGRES_PASSWORD": "p",
        "CHECKPOINT_DIR": "/c",
        "WINDOW_DURATION": "10 minutes",
        "SLIDE_DURATION": "2 minutes",
        "WATERMARK_DELAY": "1 hour",
        "TRIGGER_INTERVAL": "5 seconds",
        "DATA_PATH": "/d.csv",
        "CHUNK_SIZE": "50",
    }
    read = FlowConfig.from_env(env)
    assert (read.kafka_servers, read.kafka_topic, read.jdbc_url, read.jdbc_user) == ("b:1", "t", "jdbc:x", "u")
    assert (read.jdbc_password, read.checkpoint_dir, read.data_path, read.chunk_size) == ("p", "/c", "/d.csv", 50)
    assert read.window == WindowSpec("10 minutes", "2 minutes")
    assert (read.watermark_delay, read.trigger_interval) == ("1 hour", "5 seconds")


@pytest.mark.parametrize(
    "setting",
    [{"slide_duration": "9 minutes"}, {"chunk_size": "0"}, {"watermark_delay": "a while"}, {"trigger_interval": "often"}],
)
def test_bad_settings_are_refused_at_once(setting):
    with pytest.raises(ValueError):
        FlowConfig(**setting)


def test_checkpoint_follows_the_window_shape():
    names = {
        FlowConfig().checkpoint_name(),
        FlowConfig(window_duration="7 minutes").checkpoint_name(),
        FlowConfig(slide_duration="5 minutes").checkpoint_name(),
        FlowConfig(watermark_delay="20 minutes").checkpoint_name(),
        FlowConfig().checkpoint_name(source="a"),
        FlowConfig().checkpoint_name(source="b"),
        FlowConfig().checkpoint_name(source="a", sink="x"),
        FlowConfig().checkpoint_name(source="a", sink="y"),
    }
    assert len(names) == 8
    assert FlowConfig(window_duration="300 seconds").checkpoint_name() == FlowConfig().checkpoint_name()
