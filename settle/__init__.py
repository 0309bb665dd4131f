"""settle: how wrong was a real-time count when it was published?

Sub-packages

* ``sources``   readers: the post log (Kafka or files), the event fixture, stored tables
* ``functions`` column expressions: clocks, JSON frames, wire formats
* ``operators`` DataFrame -> DataFrame building blocks, batch and streaming alike
* ``plans``     the answers built from them, and the table writers
* ``streaming`` the three long-running queries and their writers
"""
