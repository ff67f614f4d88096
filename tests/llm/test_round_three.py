"""Round 3: memory of remembered pieces."""

from gable.llm.token_files import Encoder, default_tokenizer


def test_an_encoder_remembers_two_generations_of_100_000_pieces_at_most():
    encoder = Encoder(default_tokenizer(), 1)
    words = [f"w{i:x}q" for i in range(250_000)]
    for at in range(0, len(words), 1_000):
        encoder.encode([" ".join(words[at:at + 1_000])])
    assert len(encoder.known) + len(encoder.known.old) <= 2 * 102_000
    assert encoder.encode(["w0q w1q"])[0] == encoder.whole("w0q w1q") + encoder.end
