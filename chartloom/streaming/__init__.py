"""Change streams: decoding, routing, and jobs that keep staging and targets fresh."""
