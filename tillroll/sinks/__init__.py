"""Writers. All of them write from the executors; nothing is collected."""
