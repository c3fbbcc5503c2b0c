"""cueflow: DataFrame operators that turn clips, cues and recordings into speech training records."""
