"""Polling the table into the topic, and streaming the topic into the lake."""
