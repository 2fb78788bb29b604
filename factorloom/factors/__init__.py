"""Two published factor collections, written as staged window columns."""
