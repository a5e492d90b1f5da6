"""One function per load: sources and stored tables in, ``Outcome`` out."""
