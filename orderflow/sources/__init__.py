"""Where orders come from and where they go: table, topic, lake, watermark state."""
