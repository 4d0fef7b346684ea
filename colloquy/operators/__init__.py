"""Report operators: frames in, frames out."""
