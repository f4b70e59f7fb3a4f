"""Tables, message topics and event intake."""
